"""Personal data by weak supervision. DataFrame functions only.

Spans of the base patterns are always kept. Looser patterns propose further
spans. On every candidate six labelers vote yes, no or nothing: two on its form,
two by gazetteer and check digits, two by context. Expectation-maximisation over
the counts of vote patterns in the whole corpus estimates how reliable each
labeler is, and a logistic classifier of spans is trained on the posteriors. It
decides which proposed spans are added.

Texts are scanned once; a document's candidates stay in its row. Only counts of
vote patterns, a few thousand at most, are gathered.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogsync.llm.common import pick, stage

# Base patterns. Possessive loops and looks behind change no match; they keep long runs linear and shallow.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Proposed spans: written-out addresses, national numbers, long network addresses, titled names.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[\[(] ?at ?[\])] ?| at )[A-Za-z0-9-]{1,63}+(?:(?: ?[\[(] ?dot ?[\])] ?| dot )[A-Za-z0-9-]{1,63}+)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+(])(?<![0-9][ .)-])(?<!\+[0-9]{1,3}[ .-]\(?)(?:\([0-9]{3}\) |[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![ .-]?[0-9])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]{1,30}(?: [A-Z][a-z]{1,30})?(?![A-Za-z])",
}
# What a text must contain for a pattern to be tried.
NEEDS = {"email": "@", "phone": "+"}
HINTS = {"email": r"\bdot\b", "ip": "[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:", "phone": "[0-9]{3}[ .-][0-9]{4}", "name": "Mr|Ms|Dr|Prof"}
KINDS = ("email", "ip", "card", "phone", "name")

# Gazetteers.
DOMAINS = "com org net edu gov int mil io co uk de fr es it nl eu us ca au jp info biz".split()
FIRST_NAMES = (
    "anna anne maria marie john james mary robert michael david sarah laura peter paul thomas susan linda lisa "
    "karl hans jean pierre jose juan carlos carmen elena sofia emma lucas martin andrea"
).split()
# Context words that speak for a kind, and words that speak against any.
CUES = {
    "email": "mail|contact|write|reach|address|correo|courriel|kontakt",
    "ip": r"\bip\b|host|server|address|login|client",
    "card": "card|visa|credit|payment|account|karte|carte|tarjeta",
    "phone": r"phone|\bcall\b|\btel\b|mobile|\bfax\b|contact|telefon|anruf",
    "name": "name|dear|patient|signed|contact|herr|frau|señor|monsieur",
}
AGAINST = r"version|isbn|order|invoice|section|figure|chapter|serial|\bpage\b|build|release"

LABELERS = ("pattern", "form", "gazetteer", "check", "cue", "edge")
ROUNDS = 40
ACCEPT = 0.9


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _places(found: Column, gaps: Column) -> Column:
    """Spans from matches and the gaps around them: running sums of lengths, in chunks so that many stay cheap."""
    span = "struct<text:string,lead:string,next:string,start:int,end:int>"

    def chunk(parts: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            one = F.struct(x["text"].alias("text"), x["lead"].alias("lead"), x["next"].alias("next"), start.alias("start"), (start + x["w"]).alias("end"))
            return F.struct((start + x["w"]).alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(parts, empty, step)

    n = F.size(found)
    parts = F.transform(
        found,
        lambda m, i: F.struct(
            m.alias("text"), F.length(m).alias("w"), F.length(gaps[i]).alias("gap"),
            F.lower(F.substring(gaps[i], -32, 32)).alias("lead"), F.substring(gaps[i + 1], 1, 1).alias("next"),
        ),
    )
    width = F.greatest(F.lit(16), F.ceil(F.sqrt(n)).cast("int"))

    def shifted(chunks: Column) -> Column:
        def move(c: Column, k: Column) -> Column:
            before = F.aggregate(F.slice(chunks, F.lit(1), k), F.lit(0), lambda acc, d: acc + d["at"])
            return let(before, lambda offset: F.transform(c["out"], lambda s: F.struct(
                s["text"].alias("text"), s["lead"].alias("lead"), s["next"].alias("next"),
                (s["start"] + offset).alias("start"), (s["end"] + offset).alias("end"),
            )))

        return F.flatten(F.transform(chunks, move))

    whole = let(F.struct(parts.alias("parts"), width.alias("width")), lambda p: let(
        F.transform(F.sequence(F.lit(0), F.floor((F.size(p["parts"]) - 1) / p["width"]).cast("int")), lambda k: chunk(F.slice(p["parts"], k * p["width"] + 1, p["width"]))),
        shifted,
    ))
    return F.when(n > 0, whole).otherwise(F.array().cast(f"array<{span}>"))


def located(text: Column, pattern: str) -> Column:
    """All leftmost matches that don't overlap: text, start, end (code points), the 32 characters before, the one after."""
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return let(both, lambda b: _places(b["found"], b["gaps"]))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""

    def add(acc: Column, k: Column) -> Column:
        digit = F.substr(number, F.length(number) - k, F.lit(1)).cast("int")
        twice = F.when(k % 2 == 1, digit * 2).otherwise(digit)
        return acc + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def valid(kind: str, text: Column) -> Column:
    """Does a match of the base pattern pass its kind's checks?"""
    if kind == "ip":
        return text.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return let(digits(text), lambda d: F.length(d).between(14, 19) & F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits(text)).between(10, 15)
    return F.lit(True)


def _sign(yes: Column, no: Column) -> Column:
    return F.when(yes, "+").when(no, "-").otherwise("0")


def votes(kind: str, base: bool, s: Column, ok: Column) -> Column:
    """A character per labeler: + for personal data, - against, 0 for no vote."""
    text, low = s["text"], F.lower(s["text"])
    if kind == "email":
        known = F.regexp_extract(low, r"([a-z0-9-]+)$", 1).isin(*DOMAINS)
        form = F.length(text).between(6, 128)
        check = _sign(low.rlike("^[a-z0-9]"), ~low.rlike("^[a-z0-9]"))
    elif kind == "ip":
        known = ~text.rlike(r"^0*(?:0|127|255)\.")
        form = F.length(text).between(7, 39)
        check = _sign(ok, ~ok) if base else F.lit("+")
    elif kind == "card":
        known = text.rlike("^[3-6]")
        form = F.length(digits(text)).between(14, 19)
        check = _sign(ok, ~ok)
    elif kind == "phone":
        known = text.rlike(r"^\+[1-9]|^\(?[2-9]")
        form = F.length(digits(text)).between(10, 15)
        check = _sign(ok, ~ok) if base else F.lit("0")
    else:
        known = F.exists(F.split(low, r"[ .]+"), lambda w: w.isin(*FIRST_NAMES))
        form = low.rlike(r" [a-z]+ [a-z]+$")
        check = F.lit("0")
    edge = s["lead"].rlike(r"[a-z0-9_]$") | s["next"].rlike("[A-Za-z0-9_]")
    return F.concat(
        _sign(F.lit(base) & ok, F.lit(False)), _sign(form, ~form), _sign(known, ~known), check,
        _sign(s["lead"].rlike(CUES[kind]), s["lead"].rlike(AGAINST)), _sign(F.lit(False), edge),
    )


def candidates(text: Column) -> Column:
    """All candidates of a text: start, place of the kind, end, kind, base (a base span), open (may be added), votes."""
    found = []
    for base, patterns in ((True, BASE), (False, LOOSE)):
        for kind, pattern in patterns.items():
            spans = F.transform(located(text, pattern), _judged(kind, base))
            needed = text.contains(NEEDS[kind]) if base and kind in NEEDS else None if base else text.rlike(HINTS[kind])
            if needed is not None:
                spans = F.when(needed, spans)
            found.append(F.coalesce(spans, F.array().cast(SPANS)))
    return F.concat(*found)


def _judged(kind: str, base: bool) -> Callable[[Column], Column]:
    """A candidate from a span of a pattern."""
    place = KINDS.index(kind)

    def build(s: Column) -> Column:
        return let(valid(kind, s["text"]) if base else F.lit(True), lambda passed: F.struct(
            s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            (F.lit(base) & passed).alias("base"), F.lit(not base).alias("open"), votes(kind, base, s, passed).alias("votes"),
        ))

    return build


SPANS = "array<struct<start:int,place:int,end:int,kind:string,base:boolean,open:boolean,votes:string>>"


@dataclass
class SpanClassifier:
    """Logistic classifier of spans: a weight for each labeler's yes and no, and for each kind."""

    bias: float
    yes: list[float]
    no: list[float]
    kind: list[float]

    def score(self, s: Column) -> Column:
        total = F.lit(self.bias)
        for k in range(len(LABELERS)):
            vote = F.substring(s["votes"], k + 1, 1)
            total = total + F.when(vote == "+", self.yes[k]).when(vote == "-", self.no[k]).otherwise(0.0)
        for k, weight in enumerate(self.kind):
            total = total + F.when(s["place"] == k, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def reliabilities(patterns: list[tuple[str, int]], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over (votes, count): P(truth) of each pattern, and P(vote | truth) of each labeler.

    Votes are taken as independent given the truth. It starts from the majority
    of the votes; a small count for every vote keeps all probabilities positive.
    """
    codes = np.array([["0+-".index(v) for v in votes] for votes, _ in patterns]).reshape(len(patterns), len(LABELERS))
    counts = np.array([n for _, n in patterns], dtype=np.float64)
    lead = (codes == 1).sum(axis=1) - (codes == 2).sum(axis=1)
    truth = 1 / (1 + np.exp(-2.0 * lead))
    table = np.zeros((2, len(LABELERS), 3))
    for _ in range(rounds):
        for y, weight in ((1, counts * truth), (0, counts * (1 - truth))):
            for k in range(len(LABELERS)):
                table[y, k] = np.bincount(codes[:, k], weights=weight, minlength=3) + 1.0
                table[y, k] /= table[y, k].sum()
        prior = (counts @ truth + 1) / (counts.sum() + 2)
        gain = math.log(prior / (1 - prior)) + sum(np.log(table[1, k, codes[:, k]] / table[0, k, codes[:, k]]) for k in range(len(LABELERS)))
        truth = 1 / (1 + np.exp(-np.clip(gain, -50, 50)))
    return truth, table


def train_classifier(patterns: list[tuple[int, str, int]], rounds: int = 300, rate: float = 0.5) -> SpanClassifier:
    """Fit the classifier to the posteriors of (place of the kind, votes, count) by gradient descent."""
    n = len(LABELERS)
    if not patterns:
        return SpanClassifier(0.0, [0.0] * n, [0.0] * n, [0.0] * len(KINDS))
    truth, _ = reliabilities([(v, c) for _, v, c in patterns])
    rows = np.zeros((len(patterns), 1 + 2 * n + len(KINDS)))
    rows[:, 0] = 1
    for r, (place, vote, _) in enumerate(patterns):
        for k in range(n):
            rows[r, 1 + k] = vote[k] == "+"
            rows[r, 1 + n + k] = vote[k] == "-"
        rows[r, 1 + 2 * n + place] = 1
    share = np.sqrt(np.array([c for *_, c in patterns], dtype=np.float64))
    share /= share.sum() or 1
    weights = np.zeros(rows.shape[1])
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-rows @ weights))
        weights += 4 * rate * (rows.T @ (share * (truth - guess)) - 1e-3 * weights)
    return SpanClassifier(float(weights[0]), weights[1 : 1 + n].tolist(), weights[1 + n : 1 + 2 * n].tolist(), weights[1 + 2 * n :].tolist())


def find_candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One scan of the texts: ``doc_id`` and the ``spans`` of all candidates, in order; kept as a work table."""
    rows = pick(docs, doc_id=doc_id, text=text).select("doc_id", F.array_sort(candidates(F.coalesce("text", F.lit("")))).alias("spans"))
    return stage(rows, "pii")


def learn(found: DataFrame) -> SpanClassifier:
    """Train on the vote patterns of all candidates; at most 3 ** 6 patterns for each kind are gathered."""
    each = found.select(F.explode("spans").alias("s")).groupBy("s.place", "s.votes").agg(F.count(F.lit(1)).alias("n"))
    return train_classifier(sorted((r["place"], r["votes"], r["n"]) for r in each.collect()))


def _of(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """Spans of personal data in every whole text.

    Returns a row per row of ``docs``: ``doc_id``, ``n_email``, ``n_ip``,
    ``n_card``, ``n_phone`` (base spans), ``base_sha256`` (hex, of
    ``kind:start:end`` of the base spans by start and kind, joined by commas) and
    ``spans``, the same text for base and added spans. Positions count code
    points, the end exclusive. Matches that fail their kind's checks are dropped.

    A null or empty text has no spans. Null ids stay null, repeated rows each
    get their row, an empty table gives an empty one, other columns are ignored.
    Spans of different kinds may overlap. Long runs and long texts take time in
    proportion; positions of n spans in one text take n ** 1.5 small steps.
    """
    found = find_candidates(docs, doc_id, text)
    judge = learn(found)
    is_base = F.filter("spans", lambda s: s["base"])
    every = F.filter("spans", lambda s: s["base"] | F.when(s["open"], judge.score(s) >= accept).otherwise(False))
    counted = found.select("doc_id", is_base.alias("base"), every.alias("every"))
    numbers = [F.size(F.filter("base", _of(kind))).cast("long").alias(f"n_{kind}") for kind in BASE]
    return counted.select("doc_id", *numbers, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("every")).alias("spans"))
