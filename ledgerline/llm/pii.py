"""Personal data by weak supervision, in DataFrame operations only.

Four fixed patterns give the base spans. Wider patterns give candidates of other kinds by their shape alone: for
names, two or three capitalised words, with or without a title. Four labelers vote on each (shape of the match,
gazetteer, words before it, surroundings). Votes are counted by pattern; expectation-maximisation on those counts
estimates each labeler's reliability for each kind. A logistic model, trained on the posteriors, decides which
candidates become spans; besides the votes it sees token shapes that no labeler looks at (words, length, whether
a sentence or line starts there), so it can part what the votes cannot. Counts are bounded by kinds, vote patterns and
shapes (``PATTERN_ROWS``), so fitting happens on the driver.

Cases: null or empty text has no spans; a candidate that overlaps a base span is dropped; repeated rows are
searched each, and count each; very long texts are searched whole, in time that grows with their length and spans; without candidates the model is the prior;
an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

BASE_KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns. Look-behinds and possessive repeats keep them from trying starts or ends that
#: cannot give the leftmost match: each finds what the plain pattern finds, in linear time. ``card`` is the
#: plain pattern's matches of 16 to 19 digits.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without this cannot match.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

MORE_KINDS = ("name", "ssn", "tel", "iban", "street")
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora"
#: Common given names of the four languages of the gazetteer.
GIVEN = (
    "James|Mary|John|Linda|Robert|Susan|Michael|Karen|David|Sarah|William|Lisa|Richard|Nancy|Joseph|Betty|Thomas|Sandra|Charles|Ashley|Christopher|Emily|Daniel|Donna|Matthew|Michelle|Anthony|Carol|Mark|Amanda|Steven|Melissa|Andrew|Deborah|Brian|Rebecca|Kevin|Laura|George|Helen|"
    "Anna|Peter|Paul|Julia|Martin|Hans|Klaus|Jürgen|Wolfgang|Stefan|Andreas|Christian|Sabine|Monika|Petra|Ursula|Claudia|Heike|Katrin|Günter|Heinrich|Friedrich|Karl|Lukas|Felix|Lena|Greta|Johanna|Ingrid|Birgit|"
    "Pierre|Jean|Marie|Claire|Sophie|Luc|Michel|Philippe|Nicolas|Antoine|François|Jacques|Louis|Camille|Chloé|Juliette|Isabelle|Nathalie|Sylvie|Céline|Hélène|Mathieu|Olivier|Étienne|"
    "Maria|María|Carlos|Luis|Carmen|Juan|José|Antonio|Manuel|Francisco|Javier|Miguel|Rafael|Pablo|Diego|Sergio|Elena|Isabel|Lucía|Pilar|Rosa|Teresa|Marta|Ana|Beatriz|Jesús|Ángel|Álvaro|Sofía"
)
STREETS = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Boulevard|Blvd|Drive"
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
_CAPITAL = r"\p{Lu}[\p{Ll}]{1,30}"
CANDIDATE = {
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "tel": r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,26}(?![A-Za-z0-9])",
    "street": rf"(?<![0-9])[0-9]{{1,5}} {_CAPITAL} (?:{STREETS})(?![A-Za-z])",
    "name": rf"(?<!\p{{L}})(?:(?:{TITLES})\.? {_CAPITAL}|{_CAPITAL} {_CAPITAL})(?: {_CAPITAL})?(?!\p{{L}})",
}
#: Words before a span that speak for its kind, or against all kinds.
CUES = {
    "name": r"(?i)(name|dear|regards|contact|signed|author|patient|client)[^\n]{0,20}$",
    "ssn": r"(?i)(ssn|social security|tax id|insurance)[^\n]{0,20}$",
    "tel": r"(?i)(tel|phone|call|mobile|fax|contact)[^\n]{0,20}$",
    "iban": r"(?i)(iban|account|bank|transfer|konto)[^\n]{0,20}$",
    "street": r"(?i)(address|lives|resid|street|deliver|ship)[^\n]{0,20}$",
}
AGAINST = r"(?i)(order|invoice|isbn|version|part|serial|model|sku|ref|ticket|fictional|character)[^\n]{0,12}$"
LABELERS = 4
#: Values of each token shape: words (1, 2, 3 and more), characters (under 12, under 20, more), and whether a sentence or line starts there.
SHAPES = (3, 3, 2)
#: Count rows at most: kinds, three votes of each labeler, shapes.
PATTERN_ROWS = len(MORE_KINDS) * 3**LABELERS * 3 * 3 * 2
CONTEXT = 40


def let(value: Column, body) -> Column:
    """``body`` of a column that is computed once, however often ``body`` names it, lambdas within included."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Elements that ``scan`` goes through by one aggregate, which copies what it has for each.
STEP = 64


def scan(values: Column, merge, rounds: int = 3) -> Column:
    """Running totals of an array by the associative ``merge``: in chunks of ``STEP``, then over the chunks' totals, and so
    on for ``rounds``, so that the time is linear up to ``STEP`` to the power of ``rounds`` elements (quadratic in 64ths beyond)."""

    def plain(a: Column) -> Column:
        step = lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) == 0, x).otherwise(merge(F.element_at(acc, -1), x))))
        return F.aggregate(a, F.array().cast("array<int>"), lambda acc, x: F.when(F.size(acc) == 0, F.array(x)).otherwise(step(acc, x)))

    if not rounds:
        return plain(values)

    def chunked(a: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / STEP).cast("int")), lambda i: plain(F.slice(a, i * STEP + 1, F.lit(STEP))))

        def shifted(c: Column) -> Column:
            totals = scan(F.transform(c, lambda x: F.element_at(x, -1)), merge, rounds - 1)
            return let(totals, lambda t: F.flatten(F.transform(c, lambda chunk, i: F.when(i == 0, chunk).otherwise(let(F.get(t, i - 1), lambda before: F.transform(chunk, lambda x: merge(before, x)))))))

        return let(chunks, shifted)

    return let(values, lambda a: F.when(F.size(a) <= STEP, plain(a)).otherwise(chunked(a)))


def located(text: Column, pattern: str, values: Column, flags_left: bool = False) -> Column:
    """Array of (start, end, value, left) for ``values``, all matches of ``pattern`` in order: what lies between
    them gives the places. Code points, end exclusive; left is up to ``CONTEXT`` characters since the last match."""
    none = F.array().cast("array<struct<start:int,end:int,value:string,left:string>>")

    def placed(v: Column) -> Column:
        def spans(gaps: Column) -> Column:
            ends = scan(F.zip_with(F.slice(gaps, 1, F.size(v)), v, lambda g, x: F.length(g) + F.length(x)), lambda a, x: a + x)
            left = lambda i: F.right(F.get(gaps, i), F.lit(CONTEXT)) if flags_left else F.lit("")
            return let(ends, lambda e: F.transform(v, lambda x, i: F.struct((F.get(e, i) - F.length(x)).alias("start"), F.get(e, i).alias("end"), x.alias("value"), left(i).alias("left"))))

        return let(F.split(text, pattern, -1), spans)

    return F.when(F.size(values) > 0, let(values, placed)).otherwise(none)


def free(more: Column, base: Column) -> Column:
    """The candidates ``more`` that no span of ``base`` overlaps: all sorted by start, and for each the last end of a base
    span up to it and the first start of one after it."""
    candidates = F.transform(more, lambda c: F.struct(c["start"].alias("start"), F.lit(0).alias("base"), c["end"].alias("end"), c["value"].alias("value"), c["left"].alias("left")))
    others = F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(1).alias("base"), b["end"].alias("end"), F.lit("").alias("value"), F.lit("").alias("left")))

    def apart(both: Column) -> Column:
        last = scan(F.transform(both, lambda s: F.when(s["base"] == 1, s["end"]).otherwise(0)), lambda a, x: F.greatest(a, x))
        after = scan(F.transform(F.reverse(both), lambda s: F.when(s["base"] == 1, s["start"]).otherwise(2**31 - 1)), lambda a, x: F.least(a, x))
        return let(last, lambda e: let(F.reverse(after), lambda f: F.filter(both, lambda s, i: (s["base"] == 0) & (F.get(e, i) <= s["start"]) & (F.get(f, i) >= s["end"]))))

    return F.when((F.size(more) == 0) | (F.size(base) == 0), candidates).otherwise(let(F.array_sort(F.concat(candidates, others)), apart))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = _digits(value)
    digit = lambda i: F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
    twice = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
    total = F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda acc, i: acc + F.when(i % 2 == 1, twice(digit(i))).otherwise(digit(i)))
    return total % 10 == 0


def _octets(value: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(999)) <= 255))


VALID = {
    "email": lambda v: F.lit(True),
    "ip": _octets,
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(8, 15),
}


# Lambdas of higher-order functions may have no default arguments, hence these.
def _valid(kind: str):
    return lambda s: VALID[kind](s["value"])


def _span_of(kind: int):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))


def _is_kind(kind: int):
    return lambda s: s["kind"] == kind


def _votes(c: Column) -> Column:
    """Kind (index into MORE_KINDS), four votes, each -1, 0 or 1, and the token shapes."""
    v, left = c["value"], c["left"]
    kind = F.lit(0)
    for i, k in enumerate(MORE_KINDS[1:], 1):
        kind = F.when(v.rlike("^(?:" + CANDIDATE[k] + ")$"), i).otherwise(kind)
    ssn = v.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
    tel = v.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}")
    lengths = F.create_map(*(F.lit(x) for k, n in sorted(IBAN_LENGTHS.items()) for x in (k, n)))
    iban = F.coalesce(F.element_at(lengths, F.substring(v, 1, 2)) == F.length(v), F.lit(False))
    yes = lambda b: F.when(b, 1).otherwise(-1)
    shape = F.when(kind == 1, yes(ssn)).when(kind == 2, yes(tel)).when(kind == 3, yes(iban)).when(kind == 4, yes(~v.startswith("0"))).otherwise(F.when(v.rlike(r"(\p{L}+) \1( |$)"), -1).when(v.rlike(rf"^(?:(?:{TITLES})\.? )?(?:\p{{Lu}}\p{{Ll}}{{2,}} ?){{2,3}}$"), 1).otherwise(0))
    country = F.coalesce(F.map_contains_key(lengths, F.substring(v, 1, 2)), F.lit(False))
    gazetteer = F.when(kind == 3, yes(country)).when(kind == 0, F.when(v.rlike(rf"^(?:(?:{TITLES})\.? |(?:{GIVEN}) )"), 1).otherwise(-1)).when(kind == 4, F.when(v.rlike(rf" (?:Street|Avenue|Road|Lane|Boulevard)$"), 1).otherwise(0)).otherwise(0)
    cue = F.lit(False)
    for i, k in enumerate(MORE_KINDS):
        cue = F.when(kind == i, left.rlike(CUES[k])).otherwise(cue)
    context = F.when(cue, 1).when(left.rlike(AGAINST), -1).otherwise(0)
    # Numbers crowd among digits, names in headings and lists of capitalised words.
    crowd = F.when(F.when(kind == 0, left.rlike(r"\p{Lu}\p{Ll}+[ ,]+$")).otherwise(F.length(_digits(left)) >= 10), -1).otherwise(0)
    words = F.least(F.size(F.split(v, " ")), F.lit(3)) - 1
    size = F.when(F.length(v) < 12, 0).when(F.length(v) < 20, 1).otherwise(2)
    opening = F.when((left == "") | left.rlike(r"[.!?:\n]\s*$"), 1).otherwise(0)
    votes = {f"v{j}": x for j, x in enumerate((shape, gazetteer, context, crowd))} | {f"t{j}": x for j, x in enumerate((words, size, opening))}
    return F.struct(c["start"].alias("start"), c["end"].alias("end"), kind.alias("kind"), *(x.cast("int").alias(n) for n, x in votes.items()))


def extract(docs: DataFrame) -> DataFrame:
    """doc_id, base: array of (kind, start, end) by kind then start; found: candidates with their votes."""
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    everything = "|".join(f"(?:{CANDIDATE[k]})" for k in ("ssn", "tel", "iban", "street", "name"))
    for kind in BASE_KINDS:
        values = F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))
        hint = F.contains("text", F.lit(HINTS[kind])) if HINTS[kind] else F.lit(True)
        out = out.withColumn(kind, F.when(hint, values).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("more", F.regexp_extract_all("text", F.lit(everything), F.lit(0)))
    places = {k: F.filter(located(F.col("text"), PATTERNS[k], F.col(k)), _valid(k)) for k in BASE_KINDS}
    out = out.select("doc_id", *(p.alias(k) for k, p in places.items()), located(F.col("text"), everything, F.col("more"), True).alias("more"))
    base = F.concat(*(F.transform(k, _span_of(i)) for i, k in enumerate(BASE_KINDS)))
    out = out.select("doc_id", base.alias("base"), "more")
    return out.select("doc_id", "base", F.transform(free(F.col("more"), F.col("base")), _votes).alias("found"))


# ---- the model, on counts of patterns: {(kind, votes, shapes): count}


def em(counts: dict[tuple, int], rounds: int = 50) -> tuple[dict[tuple, float], dict]:
    """Posterior of each pattern, and the reliabilities: P(vote | true) and P(vote | false) of each labeler for each kind.

    Pseudo-counts say that labelers are right four times in five, so few candidates move them little."""
    kinds = {k for k, _ in counts}
    prior = {k: 0.5 for k in kinds}
    pseudo = {True: {1: 4.0, 0: 5.0, -1: 1.0}, False: {1: 1.0, 0: 5.0, -1: 4.0}}
    rate = {(k, j, t): {v: n / 10 for v, n in pseudo[t].items()} for k in kinds for j in range(LABELERS) for t in (True, False)}
    posterior: dict[tuple, float] = {}
    for _ in range(rounds):
        for k, votes in counts:
            yes, no = math.log(prior[k]), math.log(1 - prior[k])
            for j, v in enumerate(votes):
                if v:
                    yes += math.log(rate[k, j, True][v] / (1 - rate[k, j, True][0]))
                    no += math.log(rate[k, j, False][v] / (1 - rate[k, j, False][0]))
            posterior[k, votes] = 1 / (1 + math.exp(min(700, no - yes)))
        for k in kinds:
            rows = [(v, n, posterior[k, v]) for (q, v), n in counts.items() if q == k]
            prior[k] = (2 + sum(n * p for _, n, p in rows)) / (4 + sum(n for _, n, _ in rows))
            for j in range(LABELERS):
                for t in (True, False):
                    mass = dict(pseudo[t])
                    for votes, n, p in rows:
                        mass[votes[j]] += n * (p if t else 1 - p)
                    total = sum(mass.values())
                    rate[k, j, t] = {v: m / total for v, m in mass.items()}
    return posterior, {"prior": prior, "rate": rate}


def _features(kind: int, votes: tuple, shapes: tuple) -> list[float]:
    return [1.0, *(float(kind == i) for i in range(len(MORE_KINDS))), *(float(v == 1) for v in votes), *(float(v == -1) for v in votes), *(float(x == i) for x, n in zip(shapes, SHAPES) for i in range(1, n))]


def train(counts: dict[tuple, int], steps: int = 2000) -> list[float]:
    """Weights of the span classifier, from the posteriors as soft labels; they start from, and are drawn toward, trust in the votes."""
    by_votes: dict[tuple, int] = {}
    for (k, v, _), n in counts.items():
        by_votes[k, v] = by_votes.get((k, v), 0) + n
    posterior, _ = em(by_votes)
    start = np.array([-0.5, *[0.0] * len(MORE_KINDS), *[1.0] * LABELERS, *[-1.0] * LABELERS, *[0.0] * sum(n - 1 for n in SHAPES)])
    if not counts:
        return start.tolist()
    x = np.array([_features(*pattern) for pattern in counts])
    n = np.array(list(counts.values()), float) / sum(counts.values())
    p = np.array([posterior[k, v] for k, v, _ in counts])
    weights = start.copy()
    for _ in range(steps):
        weights -= 0.5 * (0.05 * (weights - start) + x.T @ (n * (1 / (1 + np.exp(-x @ weights)) - p)))
    return weights.tolist()


def score(c: Column, weights: list[float]) -> Column:
    """The classifier's log-odds as an expression."""
    rest = iter(weights)
    z = F.lit(next(rest))
    for i in range(len(MORE_KINDS)):
        z = z + F.when(c["kind"] == i, next(rest)).otherwise(0.0)
    for sign in (1, -1):
        for j in range(LABELERS):
            z = z + F.when(c[f"v{j}"] == sign, next(rest)).otherwise(0.0)
    for j, values in enumerate(SHAPES):
        for i in range(1, values):
            z = z + F.when(c[f"t{j}"] == i, next(rest)).otherwise(0.0)
    return z


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans: arrays of (kind, start, end), by kind then start; kinds of BASE_KINDS + MORE_KINDS."""
    seen = stage(extract(docs), "pii")
    votes, shapes = [f"v{j}" for j in range(LABELERS)], [f"t{j}" for j in range(len(SHAPES))]
    rows = seen.select(F.explode("found").alias("f")).groupBy("f.kind", *(f"f.{v}" for v in votes + shapes)).count().collect()  # at most PATTERN_ROWS
    weights = train({(r["kind"], tuple(r[v] for v in votes), tuple(r[t] for t in shapes)): r["count"] for r in sorted(rows)})
    taken = F.filter("found", lambda c: score(c, weights) > 0)
    extra = F.transform(taken, lambda c: F.struct((c["kind"] + len(BASE_KINDS)).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return seen.select("doc_id", "base", F.array_sort(F.concat("base", extra)).alias("spans"))


def digests(docs: DataFrame) -> DataFrame:
    kinds = F.array(*map(F.lit, BASE_KINDS + MORE_KINDS))
    name = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])
    counts = [F.size(F.filter("base", _is_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)]
    return find(docs).select("doc_id", *counts, F.sha2(F.concat_ws(",", F.transform("base", name)), 256).alias("base_sha256"), F.concat_ws(",", F.transform("spans", name)).alias("spans"))
