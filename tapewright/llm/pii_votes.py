"""Personal data by base patterns and by weak supervision.

Base patterns find e-mail addresses, network addresses, card and phone numbers; their
spans always stay. Further candidates (credentials, national and bank numbers, phone
numbers without a country code) are judged by three labelers that vote "private", "not
private" or abstain: the shape of the candidate (regex), words of a gazetteer near it, and
the characters around it (context). No labeler is right for certain: expectation
maximisation over the counts of all vote patterns in the corpus estimates how often each
is right, and how common private candidates are. A span classifier (logistic regression on
the votes and the kind, fitted to those posteriors) decides which candidates are added.

Everything on rows is built-in column functions: a match's place follows from the pieces
between matches, so no shuffle is needed; only the vote pattern counts (at most 27 for
each kind) reach the driver. Defined results: a NULL or empty text has no spans; a very long
text is searched whole, in time that grows with its length; rows that repeat an id are
searched alike; extra columns are ignored. A corpus without candidates trains nothing and
adds nothing; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.columns import whole_text

# The base patterns, each with what a text must hold to be searched at all.
# Matches are those of the plain patterns, found in linear time. A repetition whose characters
# cannot be what follows it is possessive. What a match from within an unbroken run needs, one
# from the beginning of the run needs as well, so a search starts there, or where the last
# match has ended.
BASE = {
    "email": ("@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (".", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": ("", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"),
    "phone": ("+", r"\+[0-9][\x20().0-9-]+[0-9]"),
}

#: Further candidates, in the order of the span list.
CANDIDATES = {
    "secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "local_phone": r"(?<![0-9A-Za-z+.-])(?<!\+[0-9]{1,3}\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])",
}
#: Votes of the regex labeler: the strict shape of each kind.
STRICT = {
    "secret": r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}|(?:sk|pk|ghp|gho|xox[bp]|AKIA)[A-Za-z0-9_-]{16,}|eyJ[A-Za-z0-9_-]+)$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^(?:AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|HU|IE|IT|LU|NL|NO|PL|PT|SE)[0-9]{2}",
    "local_phone": r"^(?:\([2-9][0-9]{2}\)|[2-9][0-9]{2})[\x20.-][0-9]{3}[.-][0-9]{4}$",
}
#: Votes of the gazetteer: words before the candidate that name personal data, or other numbers.
NAMING = (
    "token|secret|password|passwd|pwd|apikey|api_key|api key|access key|private key|credential|auth|bearer|ssn|social security|"
    "iban|account|konto|cuenta|compte|phone|tel|telefon|call|mobile|fax|passport"
)
OTHERWISE = "sha1|sha256|md5|checksum|digest|commit|revision|isbn|issn|doi|version|build|order|invoice|page|figure"
BEFORE = 32
LABELERS = ("shape", "gazetteer", "context")
KINDS = (*BASE, *CANDIDATES)

#: Candidates whose posterior reaches this are added.
THRESHOLD = 0.5
EM_STEPS = 100
#: Elements whose running sums are computed in one go.
BLOCK = 512


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda acc, x: acc + x)


def running(lengths: Column) -> Column:
    """Sum of the elements before each element of an array of integers.

    In blocks: appending to one long array copies it every time.
    """

    def block(first: Column) -> Column:
        part = F.slice(lengths, first + 1, F.lit(BLOCK))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        step = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["all"], acc["at"]).alias("all"))
        return F.aggregate(part, start, step)

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("all"))
    join = lambda acc, x: F.struct(
        (acc["at"] + x["at"]).alias("at"), F.array_append(acc["all"], F.transform(x["all"], lambda v: v + acc["at"])).alias("all")
    )
    blocks = F.transform(F.sequence(F.lit(0), F.size(lengths) - 1, F.lit(BLOCK)), block)
    return F.when(F.size(lengths) > 0, F.flatten(F.aggregate(blocks, start, join)["all"])).otherwise(F.array().cast("array<int>"))


SPAN = "array<struct<start:int,end:int,value:string>>"


def found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their places in code points."""

    def places(m: Column) -> Column:
        # Between two starts lie a match and the piece after it.
        pieces = F.transform(F.split(m["text"], pattern), lambda p: F.char_length(p))
        sizes = F.transform(m["hits"], lambda h: F.char_length(h))
        at = running(F.zip_with(F.slice(pieces, 1, F.size(sizes)), sizes, lambda p, s: p + s))
        with_gap = F.zip_with(at, F.slice(pieces, 1, F.size(sizes)), lambda a, p: a + p)
        return F.transform(
            F.arrays_zip(with_gap.alias("at"), m["hits"].alias("hit")),
            lambda x: F.struct(x["at"].alias("start"), (x["at"] + F.char_length(x["hit"])).alias("end"), x["hit"].alias("value")),
        )

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    bound = F.transform(F.array(F.struct(text.alias("text"), hits.alias("hits"))), places)
    return F.when(F.regexp_like(text, F.lit(pattern)), F.get(bound, 0)).otherwise(F.array().cast(SPAN))


def luhn(value: Column) -> Column:
    """Whether the digits, every second one from the right doubled, add up to a multiple of ten."""
    digits = F.transform(F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), ""), lambda c: c.cast("int"))
    digits = F.filter(digits, lambda d: d.isNotNull())
    added = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)))
    return _sum(added) % 10 == 0


def _valid(kind: str):
    def digits(x: Column) -> Column:
        return F.char_length(F.regexp_replace(x["value"], "[^0-9]", ""))

    return {
        "email": lambda x: F.lit(True),
        "ip": lambda x: F.forall(F.split(x["value"], r"\."), lambda p: (F.char_length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255)),
        "card": lambda x: luhn(x["value"]),
        "phone": lambda x: digits(x).between(8, 15),
    }[kind]


def base_spans(text: Column, kind: str) -> Column:
    need, pattern = BASE[kind]
    holds = F.contains(text, F.lit(need)) if need else F.regexp_like(text, F.lit("[0-9]"))
    return F.when(holds, F.filter(found(text, pattern), _valid(kind))).otherwise(F.array().cast(SPAN))


def votes(text: Column, spans: Column, kind: str) -> Column:
    """Candidates with the three votes: 1 private, 0 not, NULL abstains."""

    def judge(x: Column) -> Column:
        before = F.lower(F.substring(text, F.greatest(F.lit(1), x["start"] + 1 - BEFORE), F.least(x["start"], F.lit(BEFORE))))
        around = F.concat(F.right(before, F.lit(3)), F.lit(" "), F.substring(text, x["end"] + 1, F.lit(1)))
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["value"].alias("value"),
            F.when(F.regexp_like(x["value"], F.lit(STRICT[kind])), 1).otherwise(0).alias("shape"),
            F.when(F.regexp_like(before, F.lit(rf"(?:^|[^a-z])(?:{NAMING})(?:[^a-z]|$)")), 1)
            .when(F.regexp_like(before, F.lit(rf"(?:^|[^a-z])(?:{OTHERWISE})(?:[^a-z]|$)")), 0)
            .alias("gazetteer"),
            F.when(F.regexp_like(around, F.lit("[=:\"'] ?.*")), 1).when(F.regexp_like(around, F.lit("[/#._]")), 0).alias("context"),
        )

    return F.transform(spans, judge)


def searched(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with base spans and candidates of every kind; no shuffle."""
    text = F.col("__text")
    rows = docs.withColumn("__text", whole_text(text_col))
    rows = rows.withColumns({f"__{k}": base_spans(text, k) for k in BASE})
    digit = F.regexp_like(text, F.lit("[0-9]"))
    rows = rows.withColumns({f"__{k}": F.when(digit, found(text, p)).otherwise(F.array().cast(SPAN)) for k, p in CANDIDATES.items()})
    taken = F.concat(*(F.col(f"__{k}") for k in BASE))

    def free(x: Column) -> Column:
        return ~F.exists(taken, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))

    return rows.withColumns({f"__{k}": votes(text, F.filter(f"__{k}", free), k) for k in CANDIDATES})


def vote_counts(rows: DataFrame) -> dict[tuple, int]:
    """How often each vote pattern of each kind occurs: (kind, vote, vote, vote) -> count."""
    every = F.concat(*(_tagged(k) for k in CANDIDATES))
    counts = rows.select(F.explode(every).alias("x")).groupBy("x.kind", *(f"x.{n}" for n in LABELERS)).count()
    return {(r["kind"], *(r[n] for n in LABELERS)): r["count"] for r in counts.collect()}


def _tagged(kind: str) -> Column:
    return F.transform(f"__{kind}", lambda x: F.struct(F.lit(kind).alias("kind"), *(x[n].alias(n) for n in LABELERS)))


def reliabilities(counts: dict[tuple, int]) -> tuple[dict[str, float], list[tuple[float, float]]]:
    """Expectation maximisation: the share of private candidates of each kind, and for each
    labeler the chance of a vote "private" on private and on other candidates."""
    priors, rates = dict.fromkeys(CANDIDATES, 0.5), [(0.8, 0.2)] * len(LABELERS)
    order = sorted(counts.items(), key=str)
    for _ in range(EM_STEPS):
        weights = [(p, c, posterior(p[1:], priors[p[0]], rates)) for p, c in order]
        for kind in priors:
            own = [(c, q) for p, c, q in weights if p[0] == kind]
            priors[kind] = (1 + sum(c * q for c, q in own)) / (2 + sum(c for c, _ in own))
        fresh = []
        for k in range(len(LABELERS)):
            voted = [(p[1 + k], c, q) for p, c, q in weights if p[1 + k] is not None]
            # Two pseudo-votes that labelers are better than chance keep the two classes apart.
            yes = (1.6 + sum(c * q * v for v, c, q in voted)) / (2 + sum(c * q for _, c, q in voted))
            no = (0.4 + sum(c * (1 - q) * v for v, c, q in voted)) / (2 + sum(c * (1 - q) for _, c, q in voted))
            fresh.append((yes, no))
        change = max(abs(a - b) for x, y in zip(fresh, rates) for a, b in zip(x, y))
        rates = fresh
        if change < 1e-9:
            break
    return priors, rates


def posterior(pattern: Iterable[int | None], prior: float, rates: list[tuple[float, float]]) -> float:
    yes, no = math.log(prior), math.log(1 - prior)
    for vote, (a, b) in zip(pattern, rates):
        if vote is not None:
            yes += math.log(a if vote else 1 - a)
            no += math.log(b if vote else 1 - b)
    return 1 / (1 + math.exp(min(500.0, no - yes)))


def span_classifier(counts: dict[tuple, int], steps: int = 1500, ridge: float = 0.001) -> list[float]:
    """Weights of the votes (private, not private) and of the kinds, by gradient ascent on the
    posteriors that the vote patterns got. A pattern weighs as the logarithm of its count, so
    that rare ones are learnt too."""
    if not counts:
        return []
    priors, rates = reliabilities(counts)
    rows = [(features(p), math.log1p(c), posterior(p[1:], priors[p[0]], rates)) for p, c in sorted(counts.items(), key=str)]
    total, weights = sum(c for _, c, _ in rows), [0.0] * (1 + 2 * len(LABELERS) + len(CANDIDATES))
    for _ in range(steps):
        gradient = [-ridge * w for w in weights]
        for x, c, q in rows:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, sum(w * v for w, v in zip(weights, x))))))
            for k, v in enumerate(x):
                gradient[k] += c / total * (q - p) * v
        weights = [w + 2.0 * g for w, g in zip(weights, gradient)]
    return weights


def features(pattern: tuple) -> list[float]:
    kind, *rest = pattern
    return [1.0, *(float(v == side) for v in rest for side in (1, 0)), *(float(kind == k) for k in CANDIDATES)]


def added(kind: str, weights: list[float]) -> Column:
    """Candidates of a kind that the classifier takes for private."""
    if not weights:
        return F.array().cast(SPAN)
    accepted = []
    options: list[tuple] = [()]
    for _ in LABELERS:
        options = [(*o, v) for o in options for v in (1, 0, None)]
    for o in options:
        z = sum(w * v for w, v in zip(weights, features((kind, *o))))
        if z >= math.log(THRESHOLD / (1 - THRESHOLD)):
            accepted.append("".join("-" if v is None else str(v) for v in o))

    def pattern(x: Column) -> Column:
        return F.concat(*(F.coalesce(x[n].cast("string"), F.lit("-")) for n in LABELERS))

    kept = F.filter(f"__{kind}", lambda x: pattern(x).isin(*accepted)) if accepted else F.filter(f"__{kind}", lambda x: F.lit(False))
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")))


def private_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``spans``: array of (kind, start, end, value), by kind, then
    start. Two passes over the texts: one counts votes, one decides."""
    docs = docs.select(*(c for c in docs.columns if c != "spans"))
    rows = searched(docs, text_col)
    weights = span_classifier(vote_counts(rows))
    rows = rows.withColumns({f"__{k}": added(k, weights) for k in CANDIDATES})

    def named(kind: str) -> Column:
        return F.transform(
            f"__{kind}", lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"))
        )

    return rows.select(*docs.columns, F.concat(*(named(k) for k in KINDS)).alias("spans"))


def listing(spans: Column) -> Column:
    """Spans as ``kind:start:end``, set off by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(rows: DataFrame) -> DataFrame:
    """``doc_id``, base counts, the digest of the base spans and the list of all spans."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *(count(k) for k in BASE),
        F.sha2(listing(base).cast("binary"), 256).alias("base_sha256"),
        listing(F.col("spans")).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets. Of spans that overlap,
    the earlier and then the longer one counts; the rest of the other is masked too."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        end = F.greatest(acc["at"], -s["minus"])
        gap = F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))
        name = F.when(s["start"] >= acc["at"], F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise("")
        return F.struct(end.alias("at"), F.concat(acc["out"], gap, name).alias("out"))

    def whole(sorted_spans: Column) -> Column:
        done = F.aggregate(sorted_spans, start, step)
        return F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.get(F.transform(F.array(order), whole), 0))
