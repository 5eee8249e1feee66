"""Mixing documents to target weights by soft domain membership.

A classifier learnt on the table of labels gives every document a posterior over
the domains (``quality`` x ``toxic``). Rates w >= 0 then minimise

    1/2 |sum_d w_d m_d p_d - target|^2 + ridge / 2 sum_d m_d (w_d - 1)^2

where m_d is the document's share of all words and p_d its posterior: expected
word totals per domain match the targets and rates stay near one. Where domains
are to be kept or dropped as a whole, rates are bounded besides: 1 or more for
documents likeliest of a kept domain, 0 for those of a dropped one. The gradient in
the m-weighted metric is p_d . r + ridge (w_d - 1) with one residual vector r for
all documents, so accelerated projected gradient needs from the cluster only r, a
sum over documents with one number per domain. A task replays the residuals so
far to have its documents' rates, so nothing is kept between rounds on executors.
Where the rounds end short of the optimum (rare domains are slow), Newton steps on
the dual, a function of the residual alone, go on to the tolerance: there the rate
is 1 - p_d . r / ridge within its bounds and r is what the totals miss.

Defined results: null or empty texts have 0 words and the posterior of a wordless
text; labels with a null are not learnt from; a repeated doc_id in labels gives a
row each; without labels there is one domain and every rate is 1; repeated rows
get equal rates; extra columns are ignored or carried; an empty table gives an
empty result.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flight_engine.llm import ftrl
from flight_engine.llm import text as tx
from flight_engine.llm.store import stage

DIM_BITS = 15
DIMS = 1 << DIM_BITS
#: Labelled documents a domain gives to the training sample (about a fifth of them calibrate).
SAMPLE_PER_DOMAIN = 1500
#: Target share of the words of each domain; domains not named share what is left evenly.
TARGETS = {"q1t0": 0.90}
#: Targets of a corpus to train on: nothing of the toxic and the low-quality domains; the others keep their own share.
CLEAN_TARGETS = {"q0t0": 0.0, "q0t1": 0.0, "q1t1": 0.0}
RIDGE, MAX_ROUNDS, TOLERANCE = 1e-3, 60, 1e-5
#: Most labelled documents that are sent to every task (a few dozen MB); more are joined by a shuffle.
MAX_SENT_LABELS = 1_000_000

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>!"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True


def _level(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Share in 1/16 steps, coarser as it grows: 0, then 1 to 5."""
    rate = part / np.maximum(whole, 1)
    return np.searchsorted([0.005, 0.03, 0.08, 0.2, 0.5], rate, side="right")


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words and distinct hashed features of each row: words, and levels of a few shares."""
    h, starts, ends, edges = tx.word_hashes(data, offsets)
    words = np.diff(edges)
    dims = (tx.mix(h) >> np.uint64(64 - DIM_BITS)).astype(np.int64)
    dims = np.maximum(dims, 64)
    size = np.diff(offsets)

    def total(flags: np.ndarray) -> np.ndarray:
        c = np.concatenate(([0], np.cumsum(flags)))
        return c[offsets[1:]] - c[offsets[:-1]]

    symbol, upper = _level(total(_SYMBOL[data]), size), _level(total(_UPPER[data]), size)
    out = []
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        own = np.unique(dims[a:b])
        fresh = int(_level(np.array([len(own)]), np.array([b - a]))[0])
        length = min(int(b - a).bit_length(), 15)
        out.append(np.concatenate(([0, 8 + symbol[i], 16 + upper[i], 24 + fresh, 32 + length], own)))
    return words, out


def label_domains(labels: DataFrame) -> DataFrame:
    return (labels.where("doc_id is not null and quality is not null and toxic is not null")
            .select(F.col("doc_id").cast("long").alias("label_id"),
                    F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string")).alias("domain")))


class Classifier:
    """Domains and their weights; an empty one knows a single domain."""

    def __init__(self, domains: list[str], weights: np.ndarray | None):
        self.domains, self.weights = domains, weights

    def posteriors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words, rows = _features(data, offsets)
        if self.weights is None:
            return words, np.ones((len(rows), 1))
        logits = np.array([self.weights[r].sum(axis=0) for r in rows]).reshape(-1, len(self.domains))
        return words, ftrl.softmax(logits)


def fit_classifier(docs: DataFrame, labels: DataFrame, per_domain: int = SAMPLE_PER_DOMAIN) -> Classifier:
    """Learnt on at most about ``per_domain`` labelled documents of each domain, drawn by a hash of doc_id."""
    known = label_domains(labels)
    counts = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).orderBy("domain").collect()}
    if not counts:
        return Classifier(["all"], None)
    share = F.create_map(*[F.lit(x) for d, n in counts.items() for x in (d, min(1000000, per_domain * 1000000 // n))])
    drawn = known.where(F.expr("pmod(xxhash64(label_id, 'mix'), 1000000)") < F.element_at(share, F.col("domain")))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in tx.text_blocks(batches):
            rows = [r.astype(np.int32) for r in _features(data, offsets)[1]]
            yield pa.RecordBatch.from_arrays([batch.column("label_id"), batch.column("domain"),
                                              pa.array(rows, pa.list_(pa.int32()))], ["id", "domain", "dims"])

    texts = docs.select(F.col("doc_id").cast("long").alias("label_id"), "text")
    # the drawn labels are bounded: per_domain a domain, give or take the hash
    rows = (texts.join(F.broadcast(drawn), "label_id").select("label_id", "domain", "text")
            .mapInArrow(features, "id long, domain string, dims array<int>").toArrow().to_pylist())
    rows.sort(key=lambda r: (r["id"], r["domain"], len(r["dims"])))
    domains = sorted({r["domain"] for r in rows})
    if not domains:
        return Classifier(["all"], None)
    code = {d: i for i, d in enumerate(domains)}
    made = [(np.array(r["dims"], dtype=np.int64), code[r["domain"]]) for r in rows]
    learn = [(x, np.ones(len(x)), y) for i, (x, y) in enumerate(made) if i % 5]
    held = [m for i, m in enumerate(made) if i % 5 == 0]
    w = ftrl.train(learn or [(x, np.ones(len(x)), y) for x, y in held], DIMS, len(domains), epochs=3, alpha=0.1, l1=0.5, l2=1.0)
    # the sample holds domains evenly; back to how often the labels have them
    prior = np.log([counts[d] / min(counts[d], per_domain) for d in domains])
    t = ftrl.temperature(np.array([w[x].sum(axis=0) for x, _ in held]), np.array([y for _, y in held], dtype=int))
    w = w / t
    w[0] += prior
    return Classifier(domains, w)


def posteriors(model: Classifier, docs: DataFrame, residuals: np.ndarray | None = None, ridge: float = RIDGE,
               kept: np.ndarray | None = None):
    """An expression of a text: its words, its posterior over the domains and its rate.

    The rate replays the residuals of the rounds so far (1 without any). A second
    column may give the number of the domain of texts whose domain is known.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    k = len(model.domains)
    seen = np.empty((0, k)) if residuals is None else residuals

    @F.arrow_udf(T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("p", T.ArrayType(T.DoubleType())),
                               T.StructField("rate", T.DoubleType())]))
    def predict(texts: pa.Array, known: pa.Array) -> pa.Array:
        n, p = [np.empty(0, np.int64)], [np.empty((0, k))]
        for _, data, offsets in tx.text_blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
            a, b = sent.value.posteriors(data, offsets)
            n.append(a)
            p.append(b)
        n, p = np.concatenate(n), np.concatenate(p)
        told = known.fill_null(-1).to_numpy(zero_copy_only=False)
        p[told >= 0] = np.eye(k)[told[told >= 0]]
        cuts = pa.array(np.arange(0, p.size + 1, k, dtype=np.int32))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(p.ravel())),
                                           pa.array(replay(p, seen, ridge, kept)[0])], ["n_tokens", "p", "rate"])

    return lambda text, known=None: predict(text, F.lit(None).cast("int") if known is None else known)


def _limits(p: np.ndarray, kept: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest rate: at least 1 where the likeliest domain is a kept one, else 0; any without ``kept``."""
    best = np.zeros(len(p), dtype=bool) if kept is None else kept[p.argmax(axis=1)]
    return np.where(best, 1.0, 0.0), np.where(best | (kept is None), np.inf, 0.0)


def replay(p: np.ndarray, residuals: np.ndarray, ridge: float, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rates of documents with posteriors p after these rounds, and their look-ahead point."""
    least, most = _limits(p, kept)
    w = ahead = np.clip(np.ones(len(p)), least, most)
    t = 1.0
    for r in residuals:
        nxt = np.clip(ahead - (p @ r + ridge * (ahead - 1)) / (1 + ridge), least, most)
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, w, t = nxt + (t - 1) / t_next * (nxt - w), nxt, t_next
    return w, ahead


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, k)


def fit_rates(members: DataFrame, target: np.ndarray, ridge: float = RIDGE, rounds: int = MAX_ROUNDS,
              tolerance: float = TOLERANCE, kept: np.ndarray | None = None) -> np.ndarray:
    """A residual over ``members(n_tokens, p)`` that ``replay`` turns into the rates of the optimum, within the tolerance."""
    total = members.agg(F.sum("n_tokens")).first()[0] or 0
    k, seen = len(target), np.empty((0, len(target)))
    for _ in range(rounds if total else 0):
        def sums(batches: Iterator[pa.RecordBatch], seen=seen) -> Iterator[pa.RecordBatch]:
            acc = np.zeros(k)
            for b in batches:
                p = _matrix(b.column("p"), k)
                acc += (replay(p, seen, ridge, kept)[1] * np.asarray(b.column("n_tokens"))) @ p
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(acc)], ["k", "s"])

        rows = members.select("n_tokens", "p").mapInArrow(sums, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
        got = np.zeros(k)
        for r in rows:
            got[r["k"]] = r["s"]
        residual = got / total - target
        still = len(seen) > 1 and np.abs(residual - seen[-1]).max() < tolerance
        seen = np.vstack([seen, residual])
        if still:
            break
    if not len(seen):
        return seen
    best, miss = _newton(members, seen[-1], target, total, ridge, kept, tolerance)
    if miss >= tolerance:
        warnings.warn(f"mixing rates stop {miss:.2g} of the words from the optimum")
    # from rates of one, a single round with this residual is the optimum's rate
    return best[None, :] * (1 + ridge) / ridge


def _dual(members: DataFrame, r: np.ndarray, target: np.ndarray, total: int, ridge: float,
          kept: np.ndarray | None) -> tuple[float, np.ndarray, np.ndarray]:
    """The dual at residual r, its gradient (r less what the totals miss) and its Hessian."""
    k = len(target)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(1 + k + k * k)
        for b in batches:
            p, n = _matrix(b.column("p"), k), np.asarray(b.column("n_tokens")).astype(float)
            least, most = _limits(p, kept)
            s = p @ r
            free = 1 - s / ridge
            w = np.clip(free, least, most)
            part = p[(free > least) & (free < most)]
            acc[0] += n @ (ridge / 2 * (w - 1) ** 2 + w * s)
            acc[1:1 + k] += (w * n) @ p
            acc[1 + k:] += (part.T @ (part * n[(free > least) & (free < most), None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(acc), dtype=np.int32)), pa.array(acc)], ["k", "s"])

    rows = members.select("n_tokens", "p").mapInArrow(sums, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    got = np.zeros(1 + k + k * k)
    for x in rows:
        got[x["k"]] = x["s"] / total
    return (r @ r / 2 + r @ target - got[0], r + target - got[1:1 + k],
            np.eye(k) + got[1 + k:].reshape(k, k) / ridge)


def _newton(members: DataFrame, r: np.ndarray, target: np.ndarray, total: int, ridge: float, kept: np.ndarray | None,
            tolerance: float) -> tuple[np.ndarray, float]:
    """The residual of the optimum and the greatest share of the words by which it is missed.

    The dual is strongly convex and quadratic in pieces, so damped steps end at the
    optimum after a few; only rounding can stop them before.
    """
    value, slope, bend = _dual(members, r, target, total, ridge, kept)
    while np.abs(slope).max() >= tolerance:
        step, size = -np.linalg.solve(bend, slope), 1.0
        while size > 1e-9:
            tried = _dual(members, r + size * step, target, total, ridge, kept)
            if tried[0] <= value + 1e-4 * size * (slope @ step) or np.abs(tried[1]).max() < tolerance:
                break
            size /= 2
        else:
            break
        r, (value, slope, bend) = r + size * step, tried
    return r, float(np.abs(slope).max())


def target_shares(domains: list[str], targets: dict[str, float] | None = None) -> np.ndarray:
    named = {d: w for d, w in (targets or TARGETS).items() if d in domains}
    rest = [d for d in domains if d not in named]
    left = max(0.0, 1 - sum(named.values()))
    out = np.array([named.get(d, left / max(len(rest), 1)) for d in domains])
    return out / out.sum() if out.sum() else np.full(len(domains), 1 / len(domains))


def own_shares(members: DataFrame, k: int) -> np.ndarray:
    """Expected share of the words of each domain in ``members(n_tokens, p)``."""
    r = members.agg(F.sum("n_tokens"), *[F.sum(F.col("n_tokens") * F.get("p", F.lit(i))) for i in range(k)]).first()
    return np.array([x or 0.0 for x in r[1:]]) / (r[0] or 1)


def keeping_targets(members: DataFrame, domains: list[str], dropped: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Targets and kept domains: those named take their target, the others their own share.

    A domain is kept unless its target is 0; where labels know no other domain than
    those, they cannot tell what to keep, and every one is kept.
    """
    own = own_shares(members, len(domains))
    kept = np.array([dropped.get(d) != 0 for d in domains])
    if not kept.any():
        return own, ~kept
    return np.array([dropped.get(d, s) for d, s in zip(domains, own)]), kept


def rate_of(model: Classifier, residuals: np.ndarray, ridge: float = RIDGE):
    """An expression of a posterior: the document's rate."""
    k = len(model.domains)

    @F.arrow_udf(T.DoubleType())
    def rate(p: pa.Array) -> pa.Array:
        return pa.array(replay(_matrix(p, k), residuals, ridge)[0])

    return rate


def copies(rate: Column, key: Column) -> Column:
    """The rate as a whole number of copies: rounded up with its fraction's probability, drawn by a hash."""
    return (F.floor(rate) + F.when(F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1000000)) < (rate - F.floor(rate)) * 1000000, 1)
            .otherwise(0)).cast("long")


def _rated(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None) -> tuple[DataFrame, list[str], np.ndarray]:
    """Rates of every document, the domains of its posterior and their targets."""
    model = fit_classifier(docs, labels)
    members = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), posteriors(model, docs)(F.col("text")).alias("m"))
                    .select("doc_id", "m.n_tokens", "m.p"), "mix-members")
    target = target_shares(model.domains, targets)
    residuals = fit_rates(members, target)
    best = F.array_position("p", F.array_max("p")).cast("int")
    rated = members.withColumn("rate", rate_of(model, residuals)(F.col("p")))
    return rated.select("doc_id", "n_tokens", F.element_at(F.array(*map(F.lit, model.domains)), best).alias("domain"),
                        F.array_max("p").alias("p_domain"), "p", "rate",
                        copies(F.col("rate"), F.col("doc_id")).alias("copies")), model.domains, target


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """doc_id, n_tokens, domain, its posterior, rate and copies of every document."""
    return _rated(docs, labels, targets)[0]


def mixing_totals(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The reached totals of ``mixing_rates`` beside the targets, a row a domain."""
    return reached_totals(*_rated(docs, labels, targets))


def reached_totals(rated: DataFrame, domains: list[str], target: np.ndarray) -> DataFrame:
    """(domain, target, reached, drawn): shares of the words by the rates and by the copies of ``rated``.

    One row a domain, in parts of all words of the documents before mixing.
    """
    part = F.posexplode(F.transform("p", lambda x: F.col("n_tokens") * x)).alias("k", "words")
    sums = (rated.select("n_tokens", "rate", "copies", part)
            .groupBy("k").agg(F.sum(F.col("rate") * F.col("words")).alias("r"), F.sum(F.col("copies") * F.col("words")).alias("c"),
                              F.sum("n_tokens").alias("n")))
    names = F.array(*map(F.lit, domains))
    return sums.select(F.get(names, F.col("k")).alias("domain"), F.get(F.array(*[F.lit(float(x)) for x in target]), F.col("k")).alias("target"),
                       (F.col("r") / F.col("n")).alias("reached"), (F.col("c") / F.col("n")).alias("drawn"))


def known_domains(labels: DataFrame, domains: list[str], targets: dict[str, float]) -> DataFrame:
    """(label_id, known, gone): number of a labelled document's domain, and whether its target is 0.

    Of several labels of one document, one with target 0 counts.
    """
    code = F.create_map(*[F.lit(x) for i, d in enumerate(domains) for x in (d, i)])
    gone = F.col("domain").isin([d for d, w in targets.items() if w == 0])
    return (label_domains(labels).groupBy("label_id").agg(F.max(F.struct(gone.alias("gone"), 
        F.try_element_at(code, F.col("domain")).alias("known"))).alias("m")).select("label_id", "m.known", "m.gone"))


def mix_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, keep_rest: bool = False) -> DataFrame:
    """The documents with one copy or more, all their columns, and mix_rate and mix_copies.

    With ``keep_rest``, domains that ``targets`` does not name keep their own share
    of the words, a document that is likeliest of a kept domain has a rate of 1 or
    more, and one that is likeliest of a domain with target 0 goes. The domain of
    labelled documents is then their label's.
    """
    model, targets = fit_classifier(docs, labels), targets or TARGETS
    rows, thin = docs.select(F.struct("*").alias("own_row")), docs.select(F.col("doc_id").cast("long").alias("own_id"), "text")
    thin = thin.select("own_id", posteriors(model, docs)(F.col("text")).alias("m")).select("own_id", "m.n_tokens", "m.p")
    known, gone = None, F.lit(False)
    if keep_rest:
        told = stage(known_domains(labels, model.domains, targets), "mix-known")
        told = F.broadcast(told) if told.count() <= MAX_SENT_LABELS else told
        # posteriors first, so that no text is joined for them; a known domain is certain
        certain = F.transform(F.sequence(F.lit(0), F.lit(len(model.domains) - 1)), lambda i: (i == F.col("known")).cast("double"))
        thin = thin.join(told, F.col("own_id") == F.col("label_id"), "left").withColumn(
            "p", F.when(F.col("known").isNotNull(), certain).otherwise(F.col("p")))
        rows = rows.join(told, F.col("own_row.doc_id").cast("long") == F.col("label_id"), "left")
        known, gone = F.col("known"), F.coalesce("gone", F.lit(False))
    members = stage(thin.select("n_tokens", "p"), "mix-members")
    target, kept = keeping_targets(members, model.domains, targets) if keep_rest else (target_shares(model.domains, targets), None)
    residuals = fit_rates(members, target, kept=kept)
    own = rows.select("own_row", gone.alias("gone"), posteriors(model, docs, residuals, kept=kept)(F.col("own_row.text"), known).alias("m"))
    own = own.select("own_row", F.when(F.col("gone"), 0.0).otherwise(F.col("m.rate")).alias("mix_rate"))
    own = own.withColumn("mix_copies", copies(F.col("mix_rate"), F.col("own_row.doc_id")))
    clash = [c for c in ("mix_rate", "mix_copies") if c in docs.columns]
    kept = own.where("mix_copies > 0").select("own_row.*", "mix_rate", "mix_copies") if not clash else \
        own.where("mix_copies > 0").select(F.col("own_row").dropFields(*clash).alias("own_row"), "mix_rate", "mix_copies").select("own_row.*", "mix_rate", "mix_copies")
    return kept
