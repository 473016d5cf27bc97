"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the base patterns of four kinds and looser forms of them (obfuscated
addresses, national phone numbers, grouped account numbers, IPv6). On each candidate
vote a regex labeler (strict form), a gazetteer labeler (top-level domains, calling codes,
issuer prefixes, address blocks), a context labeler (cue words before it) and an
edge labeler (does it stand alone?). Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is, and its posteriors train
the final span classifier, a logistic regression over votes and shape. A base span always
stays; a looser candidate becomes a span when the classifier gives it at least ``ACCEPT``.

Vote patterns and shapes are bounded (a few thousand combinations), and only their
counts reach the driver, where EM and the regression take their steps. Texts are
never exploded for the result: spans are arrays of their row, so no key can be hot.

Defined results: NULL is an empty text and has no spans; places are code points, ends
exclusive; with no candidates at all the classifier accepts none; repeated rows and ids
are handled row by row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import clean_text, plain

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
LABELERS = ("regex", "gazetteer", "context", "edge")
CONTEXT_CHARS = 24
EM_ROUNDS = 50

# Base patterns. Possessive repeats and the look-behind change no match: what they
# give up could not lead to one. They keep the search linear and free of recursion.
_MAIL_CHARS = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_MAIL_CHARS}])|\G)[{_MAIL_CHARS}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
#: Shorter runs than thirteen digits fail in any case and are not matched.
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
#: A text without this character has no match, so its patterns need not run.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z0-9-]{1,63}){1,8}+",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.()-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
}
LOOSE_NEEDS = {"email": r"(?:\[at\]|\(at\))", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]", "card": r"[A-Z]{2}[0-9]{2}", "phone": r"[0-9]{3}[\x20.-][0-9]{4}"}

# The gazetteers and cue words.
TOP_DOMAINS = "com org net edu gov info biz io co me app dev de fr es it nl uk us ca eu ch at jp cn in br example test"
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98 351 353 358 380 420 421"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38|AD|AT|BE|CH|DE|ES|FR|GB|IE|IT|LU|NL|PT)"
OUTSIDE_BLOCKS = r"^(?:0|255|24[0-9]|25[0-5])\.|^0+:"
CUES = {
    "email": "mail|contact|write|reach|correo|courriel|adresse",
    "ip": "ip|host|server|address|login|client|from",
    "card": "card|visa|master|amex|iban|account|konto|compte|cuenta|tarjeta|carte|karte|pay",
    "phone": "phone|tel|call|fax|mobile|cell|sms|whatsapp|anruf|llam|appel",
}


def _sums(values: Column) -> Column:
    """Sums of all values before each one, of an integer array; in two levels, so that long arrays stay cheap."""
    size = 256
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(values) - 1) / size), F.lit(0)).cast("int")),
        lambda b: F.slice(values, b * size + 1, size),
    )

    def running(numbers: Column) -> Column:
        start = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("before"))
        step = lambda a, v: F.struct(
            (a["total"] + v).alias("total"), F.concat(a["before"], F.array(a["total"])).alias("before")
        )
        return F.aggregate(numbers, start, step)

    inner = F.transform(blocks, running)
    outer = running(F.transform(inner, lambda x: x["total"]))["before"]
    return F.flatten(F.zip_with(inner, outer, lambda x, o: F.transform(x["before"], lambda v: v + o)))


def _pieces(df: DataFrame, name: str, pattern: str, needed: Column | None) -> DataFrame:
    """Adds ``<name>``: all matches of the pattern as (start, match, before), leftmost and not overlapping.

    The gaps that ``split`` leaves and the matches together make up the text, so their lengths give the places.
    """
    gaps, found = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    nothing = F.array().cast("array<string>")
    if needed is not None:
        gaps, found = F.when(needed, gaps).otherwise(nothing), F.when(needed, found).otherwise(nothing)
    df = df.withColumn("__found", found)
    df = df.withColumn("__gaps", F.when(F.size("__found") > 0, gaps).otherwise(nothing))
    lengths = F.zip_with(
        F.slice("__gaps", 1, F.size("__found")), "__found", lambda g, m: F.length(g) + F.length(m)
    )
    df = df.withColumn("__before", F.when(F.size("__found") > 0, _sums(lengths)).otherwise(F.array().cast("array<int>")))
    spans = F.transform(
        F.arrays_zip("__before", "__gaps", "__found"),
        lambda z: F.struct(
            (z["__before"] + F.length(z["__gaps"])).alias("start"),
            z["__found"].alias("match"),
            F.lower(F.right(z["__gaps"], F.lit(CONTEXT_CHARS))).alias("before"),
        ),
    )
    spans = F.filter(spans, lambda s: s["match"].isNotNull())
    return df.withColumn(name, spans).drop("__found", "__gaps", "__before")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _is_base(kind: str, match: Column) -> Column:
    """Does a match of the base pattern pass its check?"""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    digits = _digits(match)
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(9, 15)


def _one_of(value: Column, words: str) -> Column:
    return F.coalesce(value.isin(words.split()), F.lit(False))


def _gazetteer(kind: str, match: Column) -> Column:
    if kind == "email":
        return _one_of(F.lower(F.regexp_extract(match, r"([A-Za-z0-9-]+)$", 1)), TOP_DOMAINS)
    if kind == "ip":
        return ~match.rlike(OUTSIDE_BLOCKS)
    if kind == "card":
        return match.rlike(ISSUERS)
    code = F.regexp_extract(match, r"^\+([0-9]+)", 1)
    known = _one_of(code, CALLING_CODES)
    for n in (1, 2, 3):
        known = known | _one_of(F.substring(code, 1, n), CALLING_CODES)
    return F.when(match.startswith("+"), known).otherwise(match.rlike(r"^\(?[2-9]"))


def _votes(kind: str, span: Column, loose: bool) -> list[Column]:
    """One vote per labeler: 1 for, 0 against, -1 abstains."""
    match, before = span["match"], span["before"]
    strict = F.lit(-1) if loose else _is_base(kind, match).cast("int")
    cue = F.when(before.rlike(rf"(?:{CUES[kind]})[^a-z]*(?:\S+\s*)?$"), 1).when(before.rlike(r"[0-9=]\s?$"), 0).otherwise(-1)
    edge = F.when(before.rlike(r"[a-z0-9_.:/-]$"), 0).otherwise(1)
    return [strict, _gazetteer(kind, match).cast("int"), cue, edge]


def _shape(match: Column) -> list[Column]:
    """Length and separator count, both coarse."""
    separators = F.length(F.regexp_replace(match, r"[A-Za-z0-9]", ""))
    return [F.least(F.floor(F.length(match) / 8), F.lit(4)).cast("int"), F.least(separators, F.lit(4)).cast("int")]


def _as_candidate(k: int, kind: str, loose: bool):
    return lambda s: F.struct(
        F.lit(k).alias("kind"),
        s["start"].alias("start"),
        (s["start"] + F.length(s["match"])).alias("end"),
        (F.lit(False) if loose else F.coalesce(_is_base(kind, s["match"]), F.lit(False))).alias("base"),
        F.array(*_votes(kind, s, loose)).alias("votes"),
        F.array(*_shape(s["match"])).alias("shape"),
    )


def add_candidates(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, text, and ``candidates``: (kind number, start, end, base, votes, shape) of all forms."""
    df = docs.select(*keep, clean_text(text).alias("text"))
    parts = []
    digit = F.col("text").rlike("[0-9]")
    for k, kind in enumerate(KINDS):
        needed = digit if NEEDS[kind] is None else F.contains("text", F.lit(NEEDS[kind]))
        for loose, pattern in ((False, BASE[kind]), (True, LOOSE[kind])):
            name = f"__{kind}_{int(loose)}"
            gate = F.col("text").rlike(LOOSE_NEEDS[kind]) if loose else needed
            df = _pieces(df, name, pattern, gate)
            parts.append(F.transform(name, _as_candidate(k, kind, loose)))
    return df.select(*keep, "text", F.concat(*parts).alias("candidates"))


@dataclass
class SpanClassifier:
    """Logistic weights per kind over votes (for, against) and shape, and each labeler's estimated accuracy."""

    weights: dict[int, list[float]]
    reliability: dict[int, list[float]]

    def probability(self, candidate: Column) -> Column:
        out = F.lit(0.0)
        for kind, w in self.weights.items():
            score = F.lit(w[0])
            for i in range(len(LABELERS)):
                vote = candidate["votes"][i]
                score = score + F.when(vote == 1, w[1 + 2 * i]).when(vote == 0, w[2 + 2 * i]).otherwise(0.0)
            for i in range(2):
                score = score + candidate["shape"][i] * F.lit(w[1 + 2 * len(LABELERS) + i])
            out = F.when(candidate["kind"] == kind, 1 / (1 + F.exp(-score))).otherwise(out)
        return out


def _features(votes: tuple[int, ...], shape: tuple[int, ...]) -> list[float]:
    out = [1.0]
    for v in votes:
        out += [float(v == 1), float(v == 0)]
    return [*out, *map(float, shape)]


def estimate_reliability(counts: list[tuple[tuple[int, ...], int]]) -> tuple[dict[tuple[int, ...], float], list[float]]:
    """EM for two classes and independent labelers that may abstain: posterior per vote pattern, accuracy per labeler."""
    n = len(LABELERS)
    prior, hit, false = 0.5, [0.8] * n, [0.3] * n
    total = sum(c for _, c in counts)
    posterior: dict[tuple[int, ...], float] = {}
    for _ in range(EM_ROUNDS):
        for votes, _ in counts:
            a, b = math.log(prior), math.log(1 - prior)
            for i, v in enumerate(votes):
                if v >= 0:
                    a += math.log(hit[i] if v else 1 - hit[i])
                    b += math.log(false[i] if v else 1 - false[i])
            posterior[votes] = 1 / (1 + math.exp(min(700.0, b - a)))
        prior = _between((sum(posterior[v] * c for v, c in counts) + 1) / (total + 2))
        for i in range(n):
            yes = [(posterior[v] * c, (1 - posterior[v]) * c, v[i]) for v, c in counts if v[i] >= 0]
            hit[i] = _between((sum(p for p, _, x in yes if x) + 4) / (sum(p for p, _, _ in yes) + 5))
            false[i] = _between((sum(q for _, q, x in yes if x) + 1) / (sum(q for _, q, _ in yes) + 4))
    accuracy = [prior * hit[i] + (1 - prior) * (1 - false[i]) for i in range(n)]
    return posterior, accuracy


def _between(p: float) -> float:
    return min(0.999, max(0.001, p))


def fit_logistic(rows: list[tuple[list[float], float, float]], steps: int = 25, ridge: float = 1.0) -> list[float]:
    """Newton steps for a ridge-penalised logistic regression on (features, target, weight) rows."""
    n = len(rows[0][0])
    w = [0.0] * n
    for _ in range(steps):
        grad = [-ridge * x for x in w]
        hess = [[ridge if i == j else 0.0 for j in range(n)] for i in range(n)]
        for x, target, weight in rows:
            s = sum(a * b for a, b in zip(w, x))
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, s))))
            d, v = weight * (target - p), weight * p * (1 - p)
            for i, a in enumerate(x):
                if a:
                    grad[i] += d * a
                    for j, b in enumerate(x):
                        hess[i][j] += v * a * b
        w = [a + b for a, b in zip(w, _solve(hess, grad))]
    return w


def _solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """Gaussian elimination with pivoting."""
    n = len(right)
    rows = [[*r, b] for r, b in zip(matrix, right)]
    for i in range(n):
        best = max(range(i, n), key=lambda k: abs(rows[k][i]))
        rows[i], rows[best] = rows[best], rows[i]
        for k in range(n):
            if k != i and rows[k][i]:
                f = rows[k][i] / rows[i][i]
                rows[k] = [a - f * b for a, b in zip(rows[k], rows[i])]
    return [rows[i][n] / rows[i][i] for i in range(n)]


def train_classifier(candidates: DataFrame) -> SpanClassifier:
    """Counts vote patterns and shapes over all candidates, then EM and the regression over those counts."""
    one = candidates.select(F.explode("candidates").alias("c"))
    counted = one.groupBy("c.kind", "c.votes", "c.shape").count().collect()  # at most 4 x 81 x 25 rows
    weights, reliability = {}, {}
    for kind in range(len(KINDS)):
        rows = sorted((tuple(r["votes"]), tuple(r["shape"]), r["count"]) for r in counted if r["kind"] == kind)
        if not rows:
            continue
        by_votes: dict[tuple[int, ...], int] = {}
        for votes, _, n in rows:
            by_votes[votes] = by_votes.get(votes, 0) + n
        posterior, reliability[kind] = estimate_reliability(sorted(by_votes.items()))
        scale = 1000.0 / max(1000.0, sum(n for _, _, n in rows))
        weights[kind] = fit_logistic([(_features(v, s), posterior[v], n * scale) for v, s, n in rows])
    return SpanClassifier(weights, reliability)


def _accepted(candidates: str, model: SpanClassifier, accept: float) -> Column:
    """Base spans, and accepted others that no base span of the kind touches; ordered by kind, then start."""
    base = F.filter(candidates, lambda c: c["base"])
    more = F.filter(
        candidates,
        lambda c: ~c["base"]
        & (c["votes"][0] == -1)
        & (model.probability(c) >= accept)
        & ~F.exists(base, lambda b: (b["kind"] == c["kind"]) & (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    slim = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base"))
    return F.array_sort(F.transform(F.concat(base, more), slim))


def find_personal_data(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), accept: float = ACCEPT
) -> DataFrame:
    """The kept columns, text (never NULL) and ``spans``: (kind number, start, end, base) by kind and start."""
    candidates = add_candidates(docs, text, keep)
    model = train_classifier(candidates)
    return candidates.select(*keep, "text", _accepted("candidates", model, accept).alias("spans"))


def span_list(spans: Column | str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def mask_text(text: str, spans: str) -> Column:
    """The text with each run of overlapping spans replaced by the mark of its first kind."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    by_place = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(F.col(text), done["at"] + 1, span["start"] - done["at"])
        parts = F.when(
            span["start"] >= done["at"], F.concat(done["parts"], F.array(gap, F.element_at(names, span["kind"] + 1)))
        ).otherwise(done["parts"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), parts.alias("parts"))

    ended = lambda d: F.concat(F.array_join(d["parts"], ""), F.substring(F.col(text), d["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, F.col(text)).otherwise(F.aggregate(by_place, start, step, ended))


def mask_personal_data(docs: DataFrame, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """All documents with all columns, personal data masked; NULL stays NULL."""
    names = docs.columns
    held = docs.select(F.struct(*[plain(n).alias(f"c{i}") for i, n in enumerate(names)]).alias("__row"), plain(text).alias("__text"))
    found = find_personal_data(held, "__text", ("__row", "__text"), accept)
    masked = found.withColumn("__masked", F.when(F.col("__text").isNotNull(), mask_text("text", "spans")))
    return masked.select(*[F.col("__masked").alias(n) if n == text else F.col(f"__row.c{i}").alias(n) for i, n in enumerate(names)])
