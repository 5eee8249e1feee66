"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans (email, ip, card, phone) follow fixed patterns and checks. Further
candidates (local phone numbers, national ids, names, bank accounts) come from
wide patterns; labelers vote for, against or not at all: a strict pattern, a
gazetteer, context words before the candidate, contrary context, a checksum or
plausibility test. Vote patterns of all candidates of the corpus are counted, and
expectation-maximisation estimates each labeler's reliability from the counts. A
logistic span classifier is trained on the resulting posteriors over the
candidates' features, again from counts of feature patterns, and decides.

Both tables of counts are bounded by the numbers of kinds and labelers, whatever
the corpus (3^5 votes and 2^10 features a kind), and are what the driver sees.
DataFrame functions only. Defined results: null or empty text has no spans;
repeated rows are scanned row by row; extra columns are ignored or carried; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flight_engine.llm.pattern_spans import label, merged, outside, overlapping, replaced, with_spans, written
from flight_engine.llm.store import stage

# Kinds and patterns of the base rules, in their order. Quantifiers
# that nothing can follow are possessive, and runs are only entered at their
# beginning or at the end of the match before, so that no pattern backtracks.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: Wide patterns of the kinds that the method adds.
WIDE = {
    "local_phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<![A-Za-z])(?:(?:Mr|Mrs|Ms|Dr|Prof)\.? )?[A-Z][a-z]{2,} [A-Z][a-z]{2,}(?![A-Za-z])",
}
KINDS = [*BASE, *WIDE]
#: What a text needs for a match at all.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "phone": r"\+[0-9]", "local_phone": r"[0-9]{3}[ .-][0-9]{4}",
         "national_id": r"[0-9]{3}-[0-9]{2}-", "account": r"[A-Z]{2}[0-9]{2}"}
STRICT = {
    "local_phone": r"^\([2-9][0-9]{2}\) [2-9][0-9]{2}-[0-9]{4}$|^[2-9][0-9]{2}([ .-])[2-9][0-9]{2}\1[0-9]{4}$",
    "national_id": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "account": r"^[A-Z]{2}[0-9]{2}[ A-Z0-9]{11,36}$",
    "name": r"^(Mr|Mrs|Ms|Dr|Prof)\.? ",
}
CONTEXT = {
    "local_phone": r"(call|phone|tel|mobile|fax|cell|contact)[a-z]*[^a-z0-9]{0,6}(me|us|at|is|no|number)?[^a-z0-9]{0,4}$",
    "national_id": r"(ssn|social security|national id|tax id|id number)[^a-z0-9]{0,12}$",
    "account": r"(iban|account|bank)[a-z]*[^a-z0-9]{0,12}$",
    "name": r"(name|dear|contact|signed|regards|patient|customer|born|author)[a-z]*[^a-z0-9]{0,8}$",
}
AGAINST = r"(version|isbn|order|invoice|section|chapter|figure|table|page|serial|part|build|rev)[a-z.]*[^a-z0-9]{0,6}$"
GAZETTEER = {
    "first": "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph "
             "Jessica Thomas Sarah Charles Karen Anna Peter Paul Maria Hans Klaus Ursula Pierre Marie Jean Sophie Carlos "
             "Carmen Jose Ana Luis Elena Juan Laura Emma Lukas Leon Mia".split(),
    "last": "Smith Johnson Williams Brown Jones Garcia Miller Davis Rodriguez Martinez Hernandez Lopez Wilson Anderson "
            "Taylor Moore Jackson Martin Lee Thompson White Mueller Schmidt Schneider Fischer Weber Meyer Wagner Becker "
            "Dubois Durand Moreau Bernard Petit Leroy Gonzalez Fernandez Perez Sanchez Ramirez Torres".split(),
}
#: ISO country codes that bank accounts begin with.
ACCOUNT_COUNTRIES = "AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT RO SE".split()

VOTES = ["strict", "gazetteer", "context", "against", "check"]
FEATURES = ["strict", "gazetteer", "context", "against", "check", "near_base", "line_start", "spaced", "long", "varied"]
#: A kind is a span where the classifier's probability is over this.
THRESHOLD = 0.5
EM_ROUNDS, PRIOR = 50, 0.2


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    doubled = F.transform(each, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda acc, v: acc + v) % 10 == 0


def _base_spans() -> dict[str, Column]:
    """The matches of each base pattern that pass its checks; to apply after ``with_spans``."""
    return {
        "email": F.col("email"),
        "ip": F.filter("ip", lambda s: s["m"].rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        "card": F.filter("card", lambda s: F.length(_digits(s["m"])).between(16, 19) & luhn(_digits(s["m"]))),
        "phone": F.filter("phone", lambda s: F.length(_digits(s["m"])).between(8, 15)),
    }


def _votes(kind: str, s: Column) -> dict[str, Column]:
    """What each labeler says of a candidate: 1 for, -1 against, 0 nothing."""
    m, before = s["m"], F.lower(s["before"])
    say = lambda yes, no=None: F.when(yes, 1).when(no, -1).otherwise(0) if no is not None else F.when(yes, 1).otherwise(0)
    words = F.split(F.regexp_replace(m, r"^(Mr|Mrs|Ms|Dr|Prof)\.? ", ""), " ")
    first = F.array(*map(F.lit, GAZETTEER["first"]))
    last = F.array(*map(F.lit, GAZETTEER["last"]))
    if kind == "name":
        known = F.array_contains(first, F.get(words, F.lit(0))).cast("int") + F.array_contains(last, F.get(words, F.lit(1))).cast("int")
        gazetteer, check = say(known > 0, known == 0), say(known == 2, known == 0)
    elif kind == "account":
        gazetteer = say(F.substring(m, 1, 2).isin(ACCOUNT_COUNTRIES), ~F.substring(m, 1, 2).isin(ACCOUNT_COUNTRIES))
        check = say(F.length(F.regexp_replace(m, " ", "")).between(15, 34) & _mod97(m), ~_mod97(m))
    else:
        d = _digits(m)
        gazetteer = F.lit(0)
        same = d.rlike(r"^(\d)\1+$") | d.rlike("^0123456789|^1234567890|^123456789$")
        check = say(~same & (F.size(F.array_distinct(F.split(d, ""))) > 4), same)
    return {"strict": say(m.rlike(STRICT[kind]), ~m.rlike(STRICT[kind])), "gazetteer": gazetteer,
            "context": say(before.rlike(CONTEXT[kind])), "against": F.when(before.rlike(AGAINST), -1).otherwise(0), "check": check}


def _mod97(m: Column) -> Column:
    """The ISO 7064 check of a bank account number."""
    plain = F.regexp_replace(m, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    each = F.filter(F.split(moved, ""), lambda c: c != "")
    return F.aggregate(each, F.lit(0), lambda acc, c: (
        F.when(c.rlike("[0-9]"), acc * 10 + F.coalesce(c.try_cast("int"), F.lit(0)))
        .otherwise(acc * 100 + F.ascii(c) - 55)) % 97) == 1


def _candidate(kind: str, s: Column, near: Column) -> Column:
    """A candidate as (start, end, kind, votes, features); both as short strings."""
    votes = _votes(kind, s)
    more = {"near_base": near, "line_start": s["before"].rlike(r"(^|\n)\s*$"), "spaced": s["m"].contains(" "),
            "long": F.length(s["m"]) > 14, "varied": F.size(F.array_distinct(F.split(s["m"], ""))) > 8}
    features = [votes[v] != 0 if v == "against" else votes[v] > 0 for v in VOTES] + list(more.values())
    return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"),
                    F.concat_ws("", *[F.element_at(F.array(F.lit("-"), F.lit("0"), F.lit("+")), votes[v] + 2) for v in VOTES]).alias("votes"),
                    F.concat_ws("", *[f.cast("int").cast("string") for f in features]).alias("features"))


def _of_kind(kind: str) -> Column:
    """The spans of a kind, with its name in them."""
    return F.transform(kind, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "end", "m", "before")], F.lit(kind).alias("kind")))


def _scanned(docs: DataFrame) -> DataFrame:
    """doc, base (start, end, kind by kind) and candidates outside of base spans."""
    rows = with_spans(docs.select(F.col("doc"), F.coalesce(F.col("doc.text"), F.lit("")).alias("text")), "text", BASE | WIDE, NEEDS).drop("text")
    base = F.concat(*[label(k, c) for k, c in _base_spans().items()])
    # all kinds in one array, so that overlaps are worked out once
    rows = rows.select("doc", base.alias("base"), F.concat(*map(_of_kind, WIDE)).alias("wide"))
    rows = rows.select("doc", "base", outside(F.col("wide"), F.col("base")).alias("wide"))
    rows = rows.select("doc", "base", "wide", overlapping(F.col("wide"), F.col("base"), 40).alias("near"))

    def candidate(s: Column, i: Column) -> Column:
        near, kinds = F.get(F.col("near"), i), list(WIDE)
        out = _candidate(kinds[-1], s, near)
        for kind in kinds[:-1]:
            out = F.when(s["kind"] == kind, _candidate(kind, s, near)).otherwise(out)
        return out

    return rows.select("doc", "base", F.transform("wide", candidate).alias("wide"))


def estimate(counts: dict[str, int], rounds: int = EM_ROUNDS) -> dict[str, float]:
    """Posterior of each vote pattern by EM over labelers that are independent given the truth.

    A labeler's reliability is its probability of each vote for true and for false
    candidates. Starts from the balance of votes; counts carry a small prior.
    """
    post = {v: 1 / (1 + math.exp(-1.5 * (v.count("+") - v.count("-")))) for v in counts}
    total = sum(counts.values())
    for _ in range(rounds):
        good = sum(n * post[v] for v, n in counts.items())
        share = (good + PRIOR) / (total + 2 * PRIOR)
        rate = {}
        for i in range(len(VOTES)):
            for c in "-0+":
                for truth in (True, False):
                    hit = sum(n * (post[v] if truth else 1 - post[v]) for v, n in counts.items() if v[i] == c)
                    mass = good if truth else total - good
                    lean = 0.5 + (c == "+") * truth + (c == "-") * (not truth)
                    rate[i, c, truth] = (hit + PRIOR * lean) / (mass + PRIOR * 2.5)
        new = {}
        for v in counts:
            log = math.log(share / (1 - share)) + sum(math.log(rate[i, c, True] / rate[i, c, False]) for i, c in enumerate(v))
            new[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log))))
        if max(abs(new[v] - post[v]) for v in counts) < 1e-9:
            break
        post = new
    return post


def train_classifier(rows: list[tuple[str, float, int]], rounds: int = 300, l2: float = 0.01) -> list[float]:
    """Logistic weights (bias first) on (features, target probability, count) rows, by gradient steps."""
    w = [0.0] * (len(FEATURES) + 1)
    total = sum(n for *_, n in rows) or 1
    for _ in range(rounds):
        g = [l2 * x for x in w]
        for f, target, n in rows:
            x = [1.0, *map(float, f)]
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))))
            for i, b in enumerate(x):
                g[i] += n / total * (p - target) * b
        w = [a - 1.0 * b for a, b in zip(w, g)]
    return w


def learn(docs: DataFrame) -> dict[str, list[float]]:
    """The span classifier's weights by kind, from the whole corpus."""
    # written first: exploding the expression itself makes Spark filter on it, and so scan every text again
    found = stage(_scanned(docs.select(F.struct(F.col("text").alias("text")).alias("doc"))).select("wide"), "pii-candidates")
    c = found.select(F.explode("wide").alias("c"))
    rows = c.groupBy("c.kind", "c.votes", "c.features").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "votes", "features").collect()
    out = {}
    for kind in WIDE:
        own = [r for r in rows if r["kind"] == kind]
        counts: dict[str, int] = {}
        for r in own:
            counts[r["votes"]] = counts.get(r["votes"], 0) + r["n"]
        if own:
            post = estimate(counts)
            out[kind] = train_classifier([(r["features"], post[r["votes"]], r["n"]) for r in own])
    return out


def _chosen(weights: dict[str, list[float]]) -> Column:
    """The candidates that the classifier takes, as spans."""
    cut = math.log(THRESHOLD / (1 - THRESHOLD))

    def over(s: Column) -> Column:
        out = F.lit(False)
        for kind, w in weights.items():
            score = F.lit(w[0])
            for i, x in enumerate(w[1:]):
                score = score + F.when(F.substring(s["features"], i + 1, 1) == "1", x).otherwise(0.0)
            # labelers all silent or against: no evidence to add a span on
            out = out | ((s["kind"] == kind) & s["votes"].contains("+") & (score > cut))
        return out

    return label_kind(F.filter("wide", over))


def label_kind(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc (all columns), base and spans: arrays of (start, end, kind), by kind and then start."""
    weights = learn(docs)
    rows = _scanned(docs.select(F.struct("*").alias("doc")))
    return rows.select("doc", "base", F.concat("base", _chosen(weights)).alias("spans"))


def pii_digests(docs: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    found = find_pii(docs.select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc.doc_id", *[count(k) for k in BASE], F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; overlapping spans as one.

    n_chars, where it is a column, follows the new text.
    """
    found = find_pii(docs).select("doc", F.array_sort("spans").alias("spans"))
    # written as columns, so that each step is computed once
    rows = found.select("doc", merged(F.col("spans")).alias("spans"))
    rows = rows.select("doc", replaced(F.col("doc.text"), F.col("spans")).alias("text"))
    return rows.select(*[F.col("text").alias(c) if c == "text" else
                         F.coalesce(F.length("text"), F.col(f"doc.{c}")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
                         F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
