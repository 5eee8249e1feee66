"""Secret scan: patterns, and a battery of randomness tests on other long tokens.

Candidates are runs of 20 or more token characters with a letter and a digit. Each one's encoding is
inferred (hexadecimal, base 36, 62 or 64) and its characters become codes of that
alphabet. Tests of the hypothesis "random": chi-squared uniformity over the
alphabet, the runs test about the middle code, and lag-one serial correlation.
The p-value against the hypothesis "written text" comes from how far chi-squared
lies below what the collision rate of text gives a token of that length.
Benjamini-Hochberg control of the false-discovery rate runs over all candidates
of the corpus within strata of encoding and length, from counts of binned
p-values, so short tokens with little evidence do not borrow from long ones. A
token is a secret if its stratum rejects text and no test rejects randomness.
Texts are read once: what is found and tested is kept beside the document's id,
and the counts and decisions are made from that.

DataFrame functions only. Defined results: null or empty text has no spans;
repeated rows are scanned row by row; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flight_engine.llm.pattern_spans import label, outside, with_spans, written
from flight_engine.llm.store import stage

# Kinds and patterns of the base rules, in their order.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
MIN_ASSIGNED = 8

MIN_TOKEN = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: What ASSIGN begins with, the first letter apart, which the scan then looks for alone.
ASSIGNS = r"""[PpSsTtAa](?i:ass(?:word|wd)|ecret|oken|pi_?key)["']?\x20*[:=]"""
#: Bytes of a text up to which it is split into words.
WORDS_BYTES = 1 << 20
KINDS = ["assign", "access", "hex", "random"]

#: encoding: pattern, alphabet, sums of squared and cubed letter shares of text in it.
ENCODINGS = {
    "hex": (r"^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 0.12, 0.02),
    "base36": (r"^([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz", 0.0655, 0.0058),
    "base62": (r"^[0-9A-Za-z]+$", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.060, 0.0050),
    "base64": (r"^[0-9A-Za-z+/_=-]+$", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/-_", 0.060, 0.0050),
}
FDR = 0.01
#: p-value under which a test rejects randomness; three tests are made.
REJECT_RANDOM = 0.001 / 3
BINS, PER_DECADE = 160, 4


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution for z >= 0, within a few per cent."""
    return F.exp(-z * z / 2) / 12 + F.exp(-z * z * 2 / 3) / 4 + F.exp(-z * z * 2) / 6


def _upper(z: Column) -> Column:
    return F.when(z >= 0, _tail(z)).otherwise(1 - _tail(-z))


def _encoding(m: Column) -> Column:
    out = F.lit("base64")
    for name, (pattern, *_) in reversed(list(ENCODINGS.items())[:-1]):
        out = F.when(m.rlike(pattern), name).otherwise(out)
    return out


def _pick(encoding: Column, which: int) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for e, v in ENCODINGS.items() for x in (e, float(v[which]))]), encoding)


def _and(s: Column, kept: str, **new: Column) -> Column:
    """The fields of ``s`` named in ``kept``, and new ones."""
    return F.struct(*[s[k].alias(k) for k in kept.split()], *[v.alias(k) for k, v in new.items()])


def _tested(spans: Column) -> Column:
    """Candidates (start, end, encoding, n, text_p, random): statistics of each token.

    Each step's values are fields that the next step reads. A lambda computes what it names anew for every
    element, so a value of the whole token inside one would cost the square of the token's length.
    """

    def plain(s: Column) -> Column:
        return _and(s, "start end", plain=F.rtrim(s["m"], F.lit("=")))

    def encoded(s: Column) -> Column:
        return _and(s, "start end plain", encoding=_encoding(s["plain"]))

    def spelled(s: Column) -> Column:
        text = F.when(s["encoding"].isin("hex", "base36"), F.lower(s["plain"])).otherwise(s["plain"])
        alphabet = F.element_at(F.create_map(*[F.lit(x) for e, v in ENCODINGS.items() for x in (e, v[1])]), s["encoding"])
        return _and(s, "start end encoding", chars=F.filter(F.split(text, ""), lambda c: c != ""), alphabet=alphabet)

    def codes(s: Column) -> Column:
        return _and(s, "start end encoding", x=F.transform(s["chars"], lambda c: (F.instr(s["alphabet"], c) - 1).cast("double")),
                    a=F.length(s["alphabet"]).cast("double"), n=F.size(s["chars"]).cast("double"))

    def sums(s: Column) -> Column:
        x, n, a = s["x"], s["n"], s["a"]

        def counted(acc: Column, v: Column) -> Column:
            # equal codes stand together, and 1 + 3 + 5 + ... is the square of their number
            run = F.when(acc["v"] == v, acc["run"] + 1).otherwise(1.0)
            return F.struct(v.alias("v"), run.alias("run"), (acc["total"] + 2 * run - 1).alias("total"))

        none = F.struct(F.lit(-2.0).alias("v"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))
        pairs = F.aggregate(F.sort_array(x), none, counted, lambda acc: acc["total"])
        mean = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v) / n
        return _and(s, "start end encoding x a n", chi=pairs * a / n - n, mean=mean, high=F.transform(x, lambda v: (v >= a / 2).cast("int")))

    def moments(s: Column) -> Column:
        x, high, mean = s["x"], s["high"], s["mean"]
        up = F.aggregate(high, F.lit(0.0), lambda acc, v: acc + v)
        runs = F.aggregate(F.sequence(F.lit(1), F.size(x) - 1), F.lit(1.0),
                           lambda acc, i: acc + F.when(F.get(high, i) != F.get(high, i - 1), 1.0).otherwise(0.0))
        var = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + (v - mean) * (v - mean))
        lag = F.aggregate(F.sequence(F.lit(1), F.size(x) - 1), F.lit(0.0),
                          lambda acc, i: acc + (F.get(x, i) - mean) * (F.get(x, i - 1) - mean))
        return _and(s, "start end encoding a n chi", up=up, runs=runs, var=var, lag=lag)

    def scores(s: Column) -> Column:
        n, a, chi, up, runs, var = s["n"], s["a"], s["chi"], s["up"], s["runs"], s["var"]
        k2, k3 = _pick(s["encoding"], 2), _pick(s["encoding"], 3)
        text_mean = a * ((n - 1) * k2 + 1) - n
        text_sd = a / n * F.sqrt(4 * n * n * n * (k3 - k2 * k2) + 2 * n * n * k2 * k2)
        # Wilson-Hilferty
        d = a - 1
        chi_z = (F.pow(F.greatest(chi, F.lit(0.0)) / d, F.lit(1 / 3)) - (1 - 2 / (9 * d))) / F.sqrt(2 / (9 * d))
        expected = 2 * up * (n - up) / n + 1
        spread = F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9)))
        serial = (F.when(var > 0, s["lag"] / var).otherwise(1.0) + 1 / n) * F.sqrt(n)
        return _and(s, "start end encoding n", text_z=(text_mean - chi) / text_sd, chi_z=chi_z,
                    runs_z=F.abs((runs - expected) / spread), serial_z=F.abs(serial))

    def tests(s: Column) -> Column:
        least = F.least(_upper(s["chi_z"]), 2 * _tail(s["runs_z"]), 2 * _tail(s["serial_z"]))
        return _and(s, "start end encoding n", text_p=_upper(s["text_z"]), random=least >= REJECT_RANDOM)

    out = F.filter(spans, lambda s: s["m"].rlike("[0-9]") & s["m"].rlike("[A-Za-z]"))
    for step in (plain, encoded, spelled, codes, sums, moments, scores, tests):
        out = F.transform(out, step)
    return out


def _stratum(s: Column) -> Column:
    return F.concat_ws("/", s["encoding"], F.least(F.floor(F.log2(s["n"] / 5) * 2), F.lit(16)).cast("string"))


def _bin(s: Column) -> Column:
    """Bin of a p-value: quarter decades, the more significant the higher."""
    return F.least(F.floor(-F.log10(F.greatest(s["text_p"], F.lit(1e-300))) * PER_DECADE), F.lit(BINS)).cast("int")


def discovery_bins(candidates: DataFrame, fdr: float = FDR) -> dict[str, int]:
    """Per stratum the least bin that Benjamini-Hochberg accepts, from counts over the whole corpus.

    At most a few dozen strata of BINS counts come to the driver.
    """
    c = F.explode("tested").alias("c")
    rows = (candidates.select(c).select(_stratum(F.col("c")).alias("stratum"), _bin(F.col("c")).alias("bin"))
            .groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n")).collect())
    counts: dict[str, dict[int, int]] = {}
    for r in rows:
        counts.setdefault(r["stratum"], {})[r["bin"]] = r["n"]
    out = {}
    for stratum, bins in counts.items():
        total, found = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            found += bins[b]
            if 10 ** (-b / PER_DECADE) <= fdr * found / total:
                out[stratum] = b
    return out


def _has_long_token(text: Column) -> Column:
    """Whether ``text`` has a candidate: by its words, where one of 20 bytes is rare, which is cheaper than a pattern over all of it.

    A text of many words as an array takes much memory, so long ones go by the pattern.
    """
    by_words = F.exists(F.split(text, " ", -1), lambda w: (F.octet_length(w) >= MIN_TOKEN) & w.rlike(CANDIDATE))
    return F.when(F.octet_length(text) <= WORDS_BYTES, by_words).otherwise(text.rlike(CANDIDATE))


def _scanned(docs: DataFrame) -> DataFrame:
    """doc_id, base (start, end, kind) and tested: what is found in one reading of the texts, kept for the decisions."""
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", _has_long_token(text).alias("long"))
    # a run of 32 hexadecimal characters is part of a candidate
    needs = {"assign": (F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))) & text.rlike(ASSIGNS),
             "access": F.contains(text, F.lit("AKIA")), "hex": F.col("long"), "found": F.col("long")}
    rows = with_spans(rows, "text", {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "found": CANDIDATE}, needs)
    long_enough = F.filter("assign", lambda s: F.length(F.regexp_extract(s["m"], ASSIGN, 1)) >= MIN_ASSIGNED)
    base = F.concat(label("assign", long_enough), label("access", F.col("access")), label("hex", F.col("hex")))
    return stage(rows.select("doc_id", base.alias("base"), _tested(F.col("found")).alias("tested")), "secrets")


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, base and spans: arrays of (start, end, kind), by start and then kind."""
    rows = _scanned(docs)
    bins = discovery_bins(rows, fdr)
    if bins:
        least = F.create_map(*[F.lit(x) for s, b in sorted(bins.items()) for x in (s, b)])
        picked = F.filter("tested", lambda s: s["random"] & F.coalesce(_bin(s) >= F.element_at(least, _stratum(s)), F.lit(False)))
    else:
        picked = F.filter("tested", lambda s: F.lit(False))
    rank = F.array(*map(F.lit, KINDS))

    def ordered(spans: Column) -> Column:
        keyed = F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.transform(keyed, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))

    rows = rows.select("doc_id", "base", label("random", picked).alias("more"))
    return rows.select("doc_id", ordered(F.col("base")).alias("base"),
                       ordered(F.concat("base", outside(F.col("more"), F.col("base")))).alias("spans"))


def secret_digests(docs: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    found = find_secrets(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
