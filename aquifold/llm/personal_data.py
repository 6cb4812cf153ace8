"""Personal data in texts by weak supervision, in DataFrame functions only.

Base patterns find e-mail addresses, IP addresses, card and phone numbers; these spans always
stay. Every other token with a digit is a candidate. Labelers (shapes, a gazetteer of key
words before the token, the punctuation around it, its mix of characters, the base patterns)
vote for, against or not at all; expectation-maximisation over the counts of vote patterns
estimates how reliable each is, and a logistic span classifier trained on its soft labels
decides which candidates are added.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aquifold.llm.common import shielded, unshielded, without
from aquifold.session import stage

KINDS = ("email", "ip", "card", "phone")
#: Kind of added spans that are none of the above, such as passwords, tokens and keys.
OTHER = "secret"

_SPAN = "struct<kind:string,start:int,end:int,match:string,before:string,after:string,base:boolean>"
_LABEL = "A-Za-z0-9-"
# Characters that end a candidate token.
_STOP = r"\s,;|\"'=:()<>\[\]{}"
_TOKEN = rf"(?<![^{_STOP}])[^{_STOP}0-9]*+[0-9][^{_STOP}]*"

_WORDS_FOR = "password|passwd|pwd|passwort|contraseña|token|secret|key|login|tel|telefon|phone|mobile|call|fax|mail|card|iban|ssn|account|konto"
_WORDS_AGAINST = "version|license|licence|chapter|section|page|figure|table|part|year|no|nr|cc|by-nc|by-sa|by"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; a lambda would compute a captured expression for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Matches whose lengths are added up one by one; longer lists are summed block by block, so the work stays near-linear.
_BLOCK = 128


def _located(text: Column, pattern: str, kind: str | None, base: bool) -> Column:
    """Non-overlapping matches of ``pattern`` with code-point offsets and some text around them."""

    def total(lengths: Column) -> Column:
        return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)

    def upto(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def spans(s: Column) -> Column:
        def span(i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            before = F.get(s["before"], block) + total(F.slice(s["lengths"], block * _BLOCK + 1, i - block * _BLOCK))
            gap, match = F.get(s["gaps"], i), F.get(s["found"], i)
            start = (before + F.length(gap)).cast("int")
            return F.struct(
                F.lit(kind).cast("string").alias("kind"), start.alias("start"), (start + F.length(match)).cast("int").alias("end"),
                match.alias("match"), F.right(gap, F.lit(40)).alias("before"),
                F.left(F.get(s["gaps"], i + 1), F.lit(12)).alias("after"), F.lit(base).alias("base"),
            )

        return F.transform(upto(F.size(s["found"])), span)

    def summed(s: Column) -> Column:
        blocks = F.ceil(F.size(s["found"]) / _BLOCK).cast("int")
        sums = F.transform(upto(blocks), lambda b: total(F.slice(s["lengths"], b * _BLOCK + 1, F.lit(_BLOCK))))
        return _let(
            F.struct(s["gaps"].alias("gaps"), s["found"].alias("found"), s["lengths"].alias("lengths"), sums.alias("sums")),
            lambda t: _let(
                F.struct(
                    t["gaps"].alias("gaps"), t["found"].alias("found"), t["lengths"].alias("lengths"),
                    F.transform(upto(F.size(t["sums"])), lambda b: total(F.slice(t["sums"], F.lit(1), b))).alias("before"),
                ),
                spans,
            ),
        )

    def measured(s: Column) -> Column:
        lengths = F.transform(upto(F.size(s["found"])), lambda i: F.length(F.get(s["gaps"], i)) + F.length(F.get(s["found"], i)))
        return _let(F.struct(s["gaps"].alias("gaps"), s["found"].alias("found"), lengths.alias("lengths")), summed)

    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(F.struct(gaps.alias("gaps"), found.alias("found")), measured).cast(f"array<{_SPAN}>")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    def adds_up(backwards: Column) -> Column:
        def add(total: Column, i: Column) -> Column:
            d = F.substring(backwards, i, F.lit(1)).cast("int")
            doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
            return total + F.when(i % 2 == 0, doubled).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), F.length(backwards)), F.lit(0), add) % 10 == 0

    return _let(F.reverse(_digits(match)), adds_up)


def _octets(match: Column) -> Column:
    def small(part: Column) -> Column:
        significant = F.regexp_replace(part, "^0+", "")
        return (F.length(significant) < 3) | ((F.length(significant) == 3) & (F.left(significant, F.lit(3)) <= "255"))

    return F.forall(F.split(match, r"\."), small)


def base_spans(text: Column) -> list[Column]:
    """Arrays of spans for e-mail, IP, card and phone, in this order.

    The patterns are those of the contract, written so that no group repeats (a repeated group
    recurses in Java, which fails on very long runs): a dot that does not stand between label
    characters, or a separator not between digits, is first replaced by a character of the
    same length that ends the match.
    """
    none = F.array().cast(f"array<{_SPAN}>")
    dotted = F.regexp_replace(text, rf"(?<![{_LABEL}])\.|\.(?![{_LABEL}])", "_")
    spaced = F.regexp_replace(text, r"(?<![0-9])[\x20-]|[\x20-](?![0-9])", "x")
    has_digit = F.regexp_like(text, F.lit("[0-9]"))
    email = F.when(
        F.contains(text, F.lit("@")),
        _located(dotted, rf"[A-Za-z0-9._%+-]+@[{_LABEL}]+\.[A-Za-z0-9.-]+", "email", True),
    ).otherwise(none)
    ip = F.when(
        F.regexp_like(text, F.lit(r"[0-9]\.[0-9]")),
        F.filter(_located(text, r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "ip", True), lambda s: _octets(s["match"])),
    ).otherwise(none)

    def card(span: Column) -> Column:
        return F.length(_digits(span["match"])).between(16, 19) & _luhn(span["match"])

    cards = F.when(has_digit, F.filter(_located(spaced, r"[0-9][0-9\x20-]+", "card", True), card)).otherwise(none)
    phone = F.when(
        F.contains(text, F.lit("+")),
        F.filter(
            _located(text, r"\+[0-9][\x20().0-9-]+[0-9]", "phone", True),
            lambda s: F.length(_digits(s["match"])).between(8, 15),
        ),
    ).otherwise(none)
    return [email, ip, cards, phone]


def _candidates(text: Column, base: Column) -> Column:
    """Tokens with a digit that no base span overlaps, without the punctuation that ends a sentence."""
    def trimmed(s: Column) -> Column:
        match = F.regexp_replace(s["match"], "[.!?*#%&$]+$", "")
        digits = F.length(_digits(match))
        plain = F.regexp_like(match, F.lit(r"^[0-9().+-]+$"))
        kind = (
            F.when(F.contains(match, F.lit("@")), "email").when(F.regexp_like(match, F.lit(r"^[0-9]+(\.[0-9]+){3}$")), "ip")
            .when(plain & (digits >= 13), "card").when(plain & (digits >= 7), "phone").otherwise(OTHER)
        )
        return F.struct(
            kind.alias("kind"), s["start"].alias("start"), (s["start"] + F.length(match)).alias("end"), match.alias("match"),
            s["before"].alias("before"), s["after"].alias("after"), F.lit(False).alias("base"),
        )

    free = _let(base, lambda own: F.filter(
        F.transform(_located(text, _TOKEN, None, False), trimmed),
        lambda s: ~F.exists(own, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    ))
    return F.when(F.regexp_like(text, F.lit("[0-9]")), free).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _evidence(span: Column) -> dict[str, Column]:
    """Votes of the labelers (1, 0, -1) and two further features of a span, all of few distinct values."""
    match, before = span["match"], span["before"]
    digits, length = F.length(_digits(match)), F.length(match)
    letters = F.regexp_like(match, F.lit("[A-Za-z]"))
    return {
        "shape": _vote(
            span["base"] | F.regexp_like(match, F.lit(r"^AKIA[0-9A-Z]{12,}$|^[0-9a-fA-F]{16,}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$|^sk-[A-Za-z0-9]{16,}$")),
            F.regexp_like(match, F.lit(r"^[vV]?[0-9]{1,4}(\.[0-9]{1,3}){0,2}$")),
        ),
        "gazetteer": _vote(
            F.regexp_like(before, F.lit(rf"(?i)(?:{_WORDS_FOR})[^A-Za-z0-9]{{0,5}}$")),
            F.regexp_like(before, F.lit(rf"(?i)(?:^|[^A-Za-z])(?:{_WORDS_AGAINST})[^A-Za-z0-9]{{0,3}}$")),
        ),
        "context": _vote(
            F.regexp_like(before, F.lit(r"[=:]\s{0,2}[\"']?$")), F.regexp_like(span["after"], F.lit(r"^\s?(?:%|percent|years|days|pages)")),
        ),
        "mixture": _vote((digits >= 2) & letters & (length >= 12) | (digits >= 7), (length <= 4) | (digits == 1)),
        "pattern": _vote(span["base"], F.lit(False)),
        "longness": F.least(F.floor(length / 8), F.lit(3)).cast("int"),
        "digitness": F.floor(F.lit(3) * digits / F.greatest(length, F.lit(1))).cast("int"),
    }


LABELERS = ("shape", "gazetteer", "context", "mixture", "pattern")


def label_model(counts: dict[tuple[int, ...], int], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """Chance of personal data for each pattern of votes, by expectation-maximisation from the majority vote."""
    posterior = {v: min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for v in counts}
    for _ in range(rounds):
        prior = (1 + sum(n * posterior[v] for v, n in counts.items())) / (2 + sum(counts.values()))
        rates = []
        for j in range(len(LABELERS)):
            table = {(y, value): 1.0 for y in (0, 1) for value in (-1, 0, 1)}
            for v, n in counts.items():
                table[1, v[j]] += n * posterior[v]
                table[0, v[j]] += n * (1 - posterior[v])
            totals = {y: sum(table[y, value] for value in (-1, 0, 1)) for y in (0, 1)}
            rates.append({key: x / totals[key[0]] for key, x in table.items()})
        for v in counts:
            odds = math.log(prior / (1 - prior)) + sum(math.log(r[1, x] / r[0, x]) for r, x in zip(rates, v, strict=True))
            posterior[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return posterior


def span_classifier(spans: DataFrame) -> dict[str, float] | None:
    """Coefficients (and ``intercept``) of the final classifier; None if there is no span to learn from.

    ``spans`` has one column ``span``. It is reduced to counts of distinct evidence, at most 3**5
    vote patterns times 16 feature values, before anything reaches the driver.
    """
    evidence = spans.select(*[c.alias(n) for n, c in _evidence(F.col("span")).items()])
    names = evidence.columns
    rows = evidence.groupBy(*names).count().collect()
    if not rows:
        return None
    votes: dict[tuple[int, ...], int] = {}
    for r in rows:
        key = tuple(r[n] for n in LABELERS)
        votes[key] = votes.get(key, 0) + r["count"]
    chance = label_model(votes)
    soft = list(chain.from_iterable(
        [
            (*map(float, (r[n] for n in names)), 1.0, r["count"] * chance[tuple(r[n] for n in LABELERS)]),
            (*map(float, (r[n] for n in names)), 0.0, r["count"] * (1 - chance[tuple(r[n] for n in LABELERS)])),
        ]
        for r in rows
    ))
    frame = spans.sparkSession.createDataFrame(soft, [*names, "label", "weight"]).coalesce(1)
    data = VectorAssembler(inputCols=names, outputCol="features").transform(frame)
    model = LogisticRegression(weightCol="weight", maxIter=50, regParam=1e-3, standardization=False).fit(data)
    return dict(zip(names, map(float, model.coefficients), strict=True)) | {"intercept": float(model.intercept)}


def find_personal_data(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Documents with ``base_spans`` and ``spans``: arrays of (kind, start, end), code points, end exclusive.

    Spans are ordered by kind (e-mail, ip, card, phone, then secret), then start. Null texts count
    as empty. Columns of these names in ``docs`` are replaced, others pass through; ``keep``
    selects some. Rows are independent: repeated rows and null ids need no care. The scanned rows
    are written to the shared folder once, so that training and scoring do not scan texts twice.
    """
    docs = without(docs, "base_spans", "spans")
    columns = keep or docs.columns
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(*[F.col(f"`{c}`") for c in columns], text.alias("__text"), F.concat(*base_spans(text)).alias("__base"))
    scanned = stage(
        base.select(
            *[F.col(f"`{c}`") for c in columns], "__base", _candidates(F.col("__text"), F.col("__base")).alias("__more")
        ),
        "scanned",
    )
    learn = scanned.select(F.explode(F.concat("__base", "__more")).alias("span"))
    weights = span_classifier(learn)

    def accepted(span: Column) -> Column:
        if weights is None:
            return F.lit(False)
        total = F.lit(weights["intercept"])
        for name, value in _evidence(span).items():
            total = total + weights[name] * value
        return total >= 0

    order = F.array(*[F.lit(k) for k in (*KINDS, OTHER)])

    def short(span: Column) -> Column:
        return F.struct(span["kind"].alias("kind"), span["start"].alias("start"), span["end"].alias("end"))

    def placed(span: Column) -> Column:
        return F.struct(F.array_position(order, span["kind"]).alias("place"), span["start"].alias("start"), short(span).alias("span"))

    both = F.concat("__base", F.filter("__more", accepted))
    return scanned.select(
        *[F.col(f"`{c}`") for c in columns],
        F.transform("__base", short).alias("base_spans"),
        F.transform(F.array_sort(F.transform(both, placed)), lambda p: p["span"]).alias("spans"),
    )


def span_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; overlapping spans go as one, by the kind of the first."""
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        more = F.concat(
            state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")
        )
        longer = F.struct(F.greatest(s["end"], state["at"]).alias("at"), state["out"].alias("out"))
        return F.when(s["start"] >= state["at"], F.struct(s["end"].alias("at"), more.alias("out"))).otherwise(longer)

    rest = F.aggregate(by_start, begin, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` (null stays null) and ``n_chars``, if there, counted anew."""
    found = find_personal_data(shielded(docs, "base_spans", "spans")).withColumn("text", redacted(F.col("text"), F.col("spans")))
    if "n_chars" in found.columns:
        found = found.withColumn("n_chars", F.length("text").cast("bigint"))
    return unshielded(found, docs.columns)
