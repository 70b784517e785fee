"""Personal data by weak supervision.

Candidate spans of every kind are found with patterns; four labelers vote on
each candidate (1 yes, -1 no, 0 abstain):

* regex: whether the strict form holds (digit counts, octets, check digits);
* gazetteer: whether a list knows its part (top-level domains, issuer digits,
  calling codes, reserved networks, country codes);
* context: whether the words before it announce such data, or something else;
* edges: whether letters or digits are glued to it.

Expectation-maximisation over the vote patterns estimates how reliable each
labeler is and how likely each pattern is personal data; a logistic classifier is
then trained on those likelihoods, with votes, kind and length as features, and
decides about each span.  Base spans (email, ip, card, phone in their contract
forms) always stay; the classifier adds spans of further kinds (ssn, iban).

Texts are read once; their candidates, a few numbers each, are stored in the
shared checkpoint folder.  What reaches the driver are counts by vote pattern,
kind and length class: fewer than 6 * 3^4 * 3 rows however large the table.
DataFrame expressions only on the data; the driver fits a few weights.

Defined cases: a null text counts as empty and has no spans; very long texts are
searched whole; spans with the same start are listed in the order of kinds (ties); repeated rows are
searched one by one; without any candidate nothing is fitted; an empty table
gives an empty result; other columns are ignored.  Positions are code points,
end exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import cut, text_or_empty

#: Kinds in their order, base ones first.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "ssn", "iban")
#: Fixed values.  Possessive quantifiers and the look-behinds change no match:
#: they keep long runs of digits or letters from being tried again and again.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
}
#: What a text must hold for a kind to be looked for at all.
FIRST_LOOK = {
    "email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"\+[0-9]",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2}",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
IP_FORM = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
#: What the gazetteer knows.
KNOWN = {
    "email": r"(?i)\.(?:com|net|org|edu|gov|int|info|io|co|uk|de|fr|es|it|nl|eu|us|ca|au|jp|cn|in|br|ru|ch|at|be|se|pl)$",
    "ip": r"^(?!0\.|127\.|10\.|192\.168\.|22[4-9]\.|2[3-5][0-9]\.)",
    "card": r"^(?:3[0-9]|4|5[1-5]|2[2-7]|6)",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[0134-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "iban": r"^(?:AD|AE|AT|BE|BG|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IS|IT|LI|LT|LU|LV|MC|MT|NL|NO|PL|PT|RO|SE|SI|SK|SM|TR)",
}
ANNOUNCES = {
    "email": r"e-?mail|contact|write|address|mailto", "ip": r"\bip\b|address|host|server|client", "card": r"card|visa|master|amex|credit|payment",
    "phone": r"phone|tel|call|mobile|fax|cell|whatsapp", "ssn": r"ssn|social security|tax", "iban": r"iban|account|bank|konto|compte|cuenta",
}
MISLEADS = r"version|invoice|order|isbn|serial|sku|part no|build|chapter"
CONTEXT_CHARS = 30
LABELERS = 4
RUN = 256
_PLACES = "array<struct<start:int,s:string>>"
FEATURES = 1 + 2 * LABELERS + len(KINDS) + 2


def pieces(text: Column, kind: str) -> Column:
    """(gap, s): every match with the text before it, leftmost and without
    overlap; the last gap has no match."""
    pattern = PATTERNS[kind]
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("s"))
    return F.when(text.rlike(FIRST_LOOK[kind]), found).otherwise(F.array().cast("array<struct<gap:string,s:string>>"))


def _placed(found: Column) -> Column:
    """The length of some pieces, and their matches with places relative to it."""
    return F.aggregate(
        found, F.struct(F.lit(0).alias("at"), F.array().cast(_PLACES).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["s"]), F.lit(0))).alias("at"),
            F.when(x["s"].isNull(), acc["out"]).otherwise(
                F.concat(acc["out"], F.array(F.struct((acc["at"] + F.length(x["gap"])).alias("start"), x["s"].alias("s"))))).alias("out")))


def matches(found: Column) -> Column:
    """(start, s) of every match.  Pieces are placed in runs of ``RUN`` and the
    runs one after another, as an array that grows is copied at every step."""
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / RUN).cast("int")), lambda i: _placed(F.slice(found, i * RUN + 1, F.lit(RUN))))
    joined = F.aggregate(
        runs, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_PLACES}>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(F.transform(
            x["out"], lambda m: F.struct((m["start"] + acc["at"]).alias("start"), m["s"].alias("s"))))).alias("out")),
        lambda acc: F.flatten(acc["out"]))
    return F.when(F.size(found) > 0, joined).otherwise(F.array().cast(_PLACES))


def luhn(digits: Column) -> Column:
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda acc, i: acc + _luhn_digit(
        F.coalesce(F.substr(digits, n - i + 1, F.lit(1)).cast("int"), F.lit(0)), i))
    return total % 10 == 0


def _luhn_digit(d: Column, i: Column) -> Column:
    twice = d * 2
    return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)


def mod97(s: Column) -> Column:
    """Whether an account number, letters read as 10 to 35, leaves 1."""
    plain = F.regexp_replace(s, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.substr(plain, F.lit(1), F.lit(4)))
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).when(
        c.rlike("[0-9]"), (acc * 10 + c.try_cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def strict(kind: str, s: Column) -> Column:
    """Whether a match has the form that its kind asks for."""
    digits = F.regexp_replace(s, "[^0-9]", "")
    if kind == "ip":
        return s.rlike(IP_FORM)
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "ssn":
        return s.rlike(KNOWN["ssn"])
    return mod97(s) if kind == "iban" else F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, 1)
    return (vote.when(no, -1) if no is not None else vote).otherwise(0 if no is not None else -1)


def judged(text: Column, found: Column, kind: str) -> Column:
    """Spans of one kind with the labelers' votes."""

    def span(x: Column) -> Column:
        start, s = x["start"], x["s"]
        end = start + F.length(s)
        before = F.lower(F.substr(text, F.greatest(start - CONTEXT_CHARS, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT_CHARS))))
        glued = F.substr(text, start, F.lit(1)).rlike(r"[\p{L}\p{N}]") & (start > 0) | F.substr(text, end + 1, F.lit(1)).rlike(r"[\p{L}\p{N}]")
        ok = strict(kind, s)
        return F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"),
            (ok if kind in BASE_KINDS else F.lit(False)).alias("base"),
            _vote(ok).alias("v0"), _vote(s.rlike(KNOWN[kind])).alias("v1"),
            _vote(before.rlike(ANNOUNCES[kind]), before.rlike(MISLEADS)).alias("v2"), _vote(~glued).alias("v3"),
            F.when(F.length(s) < 12, 0).when(F.length(s) < 20, 1).otherwise(2).alias("size"))

    return F.transform(found, span)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and the candidate spans of each row, stored."""
    # One column after another: an expression that is used in a lambda must be
    # a column of the step before, or it is worked out for each element.
    step = docs.select("doc_id", text_or_empty().alias("t"))
    step = step.select("doc_id", "t", *[pieces(F.col("t"), k).alias(f"p_{k}") for k in KINDS])
    step = step.select("doc_id", "t", *[matches(F.col(f"p_{k}")).alias(f"m_{k}") for k in KINDS])
    spans = F.concat(*[judged(F.col("t"), F.col(f"m_{k}"), k) for k in KINDS])
    return cut(step.select("doc_id", F.when(sum((F.size(f"m_{k}") for k in KINDS), F.lit(0)) > 0, spans).alias("spans")))


# --- the driver's part: a few hundred counts ---------------------------------

Pattern = tuple[int, int, tuple[int, ...]]  # kind, size class, votes


def likelihoods(patterns: dict[Pattern, int], rounds: int = 100) -> dict[Pattern, float]:
    """How likely a candidate with such votes is personal data, by
    expectation-maximisation with one reliability table for each labeler."""
    belief = {p: min(max(0.5 + sum(p[2]) / (2 * LABELERS + 2), 0.05), 0.95) for p in patterns}
    for _ in range(rounds):
        yes = sum(n * belief[p] for p, n in patterns.items())
        no = sum(n * (1 - belief[p]) for p, n in patterns.items())
        prior = (yes + 1) / (yes + no + 2)
        table = {}
        for labeler in range(LABELERS):
            for vote in (-1, 0, 1):
                own = [(p, n) for p, n in patterns.items() if p[2][labeler] == vote]
                table[labeler, vote] = ((sum(n * belief[p] for p, n in own) + (2 if vote > 0 else 1)) / (yes + 4),
                                        (sum(n * (1 - belief[p]) for p, n in own) + (2 if vote < 0 else 1)) / (no + 4))
        moved = 0.0
        for p in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[i, v][0] / table[i, v][1]) for i, v in enumerate(p[2]))
            new = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            moved = max(moved, abs(new - belief[p]))
            belief[p] = new
        if moved < 1e-6:
            break
    return belief


def _features(p: Pattern) -> list[float]:
    kind, size, votes = p
    return [1.0, *[float(v == 1) for v in votes], *[float(v == -1) for v in votes], *[float(kind == k) for k in range(len(KINDS))],
            float(size == 1), float(size == 2)]


def train_classifier(patterns: dict[Pattern, int], belief: dict[Pattern, float], rounds: int = 400, ridge: float = 1.0) -> list[float]:
    """Logistic weights on the likelihoods, by gradient steps on the counts."""
    weights = [0.0] * FEATURES
    total = float(sum(patterns.values())) or 1.0
    rows = [(_features(p), n / total, belief[p]) for p, n in sorted(patterns.items())]
    for _ in range(rounds):
        slope = [ridge / total * w for w in weights]
        for x, share, y in rows:
            z = max(-30.0, min(30.0, sum(w * f for w, f in zip(weights, x, strict=True))))
            miss = share * (1 / (1 + math.exp(-z)) - y)
            for i, f in enumerate(x):
                if f:
                    slope[i] += miss * f
        weights = [w - s for w, s in zip(weights, slope, strict=True)]
    return weights


def fit(spans: DataFrame) -> list[float] | None:
    """The classifier's weights; None without candidates."""
    each = spans.select(F.explode("spans").alias("s")).select("s.*")
    votes = [f"v{i}" for i in range(LABELERS)]
    rows = each.groupBy("kind", "size", *votes).count().collect()
    patterns = {(r["kind"], r["size"], tuple(r[v] for v in votes)): r["count"] for r in rows}
    return train_classifier(patterns, likelihoods(patterns)) if patterns else None


def personal(s: Column, weights: Iterable[float]) -> Column:
    """The classifier's verdict on one span."""
    w = list(weights)
    terms = [F.lit(w[0])]
    for i in range(LABELERS):
        terms.append(F.when(s[f"v{i}"] == 1, w[1 + i]).when(s[f"v{i}"] == -1, w[1 + LABELERS + i]).otherwise(0.0))
    at = 1 + 2 * LABELERS
    terms.append(F.element_at(F.array(*map(F.lit, w[at:at + len(KINDS)])), s["kind"] + 1))
    terms.append(F.when(s["size"] == 1, w[-2]).when(s["size"] == 2, w[-1]).otherwise(0.0))
    return sum(terms[1:], terms[0]) >= 0


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id and ``found``: (start, kind, end, base) of every span, sorted."""
    stored = candidates(docs)
    weights = fit(stored)
    extra = F.array(*[F.lit(KINDS.index(k)) for k in KINDS if k not in BASE_KINDS])
    none = F.array().cast("array<struct<start:int,kind:int,end:int,base:boolean>>")
    if weights is None:
        return stored.select("doc_id", none.alias("found"))
    kept = F.filter("spans", lambda s: s["base"] | (F.array_contains(extra, s["kind"]) & (s["v0"] == 1) & personal(s, weights)))
    plain = F.sort_array(F.transform(kept, lambda s: F.struct(s["start"], s["kind"], s["end"], s["base"])))
    return stored.select("doc_id", F.coalesce(plain.cast("array<struct<start:int,kind:int,end:int,base:boolean>>"), none).alias("found"))


def _base_of(kind: int) -> Callable[[Column], Column]:
    return lambda s: s["base"] & (s["kind"] == kind)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, the digest of the base spans and all spans."""
    names = F.array(*map(F.lit, KINDS))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("found", lambda s: s["base"])
    counts = [F.size(F.filter("found", _base_of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)]
    return find_spans(docs).select("doc_id", *counts, F.sha2(told(base).cast("binary"), 256).alias("base_sha256"),
                                   told(F.col("found")).alias("spans"))
