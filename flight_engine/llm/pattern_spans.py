"""Places of regular-expression matches in texts, with DataFrame functions only.

Spark returns all matches of a pattern but not where they are. The pieces between
them come from splitting at the same pattern, so running lengths of pieces and
matches give the places, in code points, end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters before a match that its span carries as context.
CONTEXT = 32

_TYPE = "array<struct<start: int, end: int, m: string, before: string>>"


def with_spans(rows: DataFrame, text: str, patterns: dict[str, str], needs: dict[str, str | Column] | None = None) -> DataFrame:
    """Adds a column of spans (start, end, m, before) for each name and pattern.

    Patterns must not match the empty string. Names must be new columns. ``needs``
    holds cheap patterns, or conditions, without which a text cannot match the one of that name.

    Write the rows before a filter on the spans: Spark moves it below the columns made here,
    and then makes all of them anew for every match.
    """
    names = list(patterns)

    def found(name: str) -> Column:
        every = F.regexp_extract_all(text, F.lit(patterns[name]), F.lit(0))
        need = (needs or {}).get(name)
        need = F.col(text).rlike(need) if isinstance(need, str) else need
        return every if need is None else F.when(need, every).otherwise(F.array().cast("array<string>"))

    def begins(name: str) -> Column:
        """Where the piece before each match begins."""
        m, g = F.col(f"{name}__m"), F.col(f"{name}__g")
        return F.when(F.size(m) > 0, running(F.transform(m, lambda x, i: F.length(F.get(g, i)) + F.length(x)), _add))

    def spans(name: str) -> Column:
        m, g, at = (F.col(f"{name}__{s}") for s in "mga")
        return F.when(F.size(m) == 0, F.array().cast(_TYPE)).otherwise(F.transform(m, lambda x, i: F.struct(
            (F.get(at, i) + F.length(F.get(g, i))).alias("start"), (F.get(at, i) + F.length(F.get(g, i)) + F.length(x)).alias("end"),
            x.alias("m"), F.right(F.get(g, i), F.lit(CONTEXT)).alias("before")))).alias(name)

    rows = rows.select("*", *[found(n).alias(f"{n}__m") for n in names])
    rows = rows.select("*", *[F.when(F.size(f"{n}__m") > 0, F.split(text, p, -1)).alias(f"{n}__g") for n, p in patterns.items()])
    rows = rows.select("*", *[begins(n).alias(f"{n}__a") for n in names])
    kept = [c for c in rows.columns if c not in {f"{n}__{s}" for n in names for s in "mga"}]
    return rows.select(*kept, *[spans(n) for n in names])


#: Elements that a running value copies at a time: n * BLOCK + (n / BLOCK)^2 copies for n elements, not n^2.
BLOCK = 128


def _add(a: Column, b: Column) -> Column:
    return a + b


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running result of ``op`` (with 0 as its start) over the elements before each one, in blocks."""

    def before(part: Column) -> Column:
        start = F.struct(F.lit(0).alias("t"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, start, lambda acc, v: F.struct(op(acc["t"], v).alias("t"), F.concat(acc["out"], F.array(acc["t"])).alias("out")))

    def whole(v: Column) -> Column:
        last = F.floor(F.greatest(F.size(v) - 1, F.lit(0)) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: before(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
        return let(blocks, lambda bl: let(before(F.transform(bl, lambda t: t["t"]))["out"], lambda heads: F.flatten(
            F.transform(bl, lambda t, i: F.transform(t["out"], lambda x: op(F.get(heads, i), x))))))

    return let(values, whole)


def ranks(queries: Column, points: Column, with_equal: bool) -> Column:
    """For each query the number of points below it (``with_equal``: or equal), by sorting them together."""
    first, second = (F.lit(0), F.lit(1)) if with_equal else (F.lit(1), F.lit(0))
    at = F.transform(points, lambda p: F.struct(p.alias("p"), first.alias("k"), F.lit(0).alias("i"), F.lit(1).alias("w")))
    ask = F.transform(queries, lambda q, i: F.struct(q.alias("p"), second.alias("k"), i.alias("i"), F.lit(0).alias("w")))

    def counted(events: Column) -> Column:
        return let(running(F.transform(events, lambda e: e["w"]), _add), lambda run: F.transform(F.array_sort(F.transform(
            F.filter(F.transform(events, lambda e, j: F.struct(e["w"].alias("w"), e["i"].alias("i"), F.get(run, j).alias("c"))), lambda x: x["w"] == 0),
            lambda x: F.struct(x["i"].alias("i"), x["c"].alias("c")))), lambda x: x["c"]))

    return let(F.array_sort(F.concat(at, ask)), counted)


#: Comparisons of every span with every other one up to which they are made; more go by sorting.
FEW = 1024


def overlapping(spans: Column, taken: Column, margin: int = 0) -> Column:
    """Whether each span, widened by ``margin``, overlaps one of those taken.

    Of the spans taken that begin before a span's end, those that end before it begins do not overlap it.
    """
    each = F.transform(spans, lambda s: F.exists(taken, lambda t: (s["start"] < t["end"] + margin) & (t["start"] < s["end"] + margin)))
    begun = ranks(F.transform(spans, lambda s: s["end"] + margin), F.transform(taken, lambda t: t["start"]), False)
    over = ranks(F.transform(spans, lambda s: s["start"] - margin), F.transform(taken, lambda t: t["end"]), True)
    by_sort = F.zip_with(begun, over, lambda x, y: x > y)
    return F.when(F.size(spans).cast("long") * F.size(taken) <= FEW, each).otherwise(by_sort)


def label(kind: str, spans: Column) -> Column:
    """Spans as (start, end, kind)."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def outside(spans: Column, taken: Column) -> Column:
    """The spans that overlap none of those taken."""
    return let(overlapping(spans, taken), lambda hit: F.filter(spans, lambda s, i: ~F.get(hit, i)))


def merged(spans: Column) -> Column:
    """Sorted spans (start, end, kind) with overlapping ones as one, of the first one's kind."""

    def join(s: Column, reach: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.get(s, i)["start"] >= F.get(reach, i))
        # a merged span reaches as far as its spans do, which is what the next first one has behind it
        return let(firsts, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(s, i)["start"].alias("start"),
            F.coalesce(F.get(reach, F.get(at, k + 1)), F.greatest(F.get(reach, F.size(s) - 1), F.get(s, F.size(s) - 1)["end"])).alias("end"),
            F.get(s, i)["kind"].alias("kind"))))

    def reached(s: Column) -> Column:
        return let(running(F.transform(s, lambda x: x["end"]), F.greatest), lambda reach: join(s, reach))

    return F.when(F.size(spans) == 0, spans).otherwise(let(spans, reached))


#: Characters a text is cut into, so that a piece of it is found without reading it from the start.
CUT = 1024


def replaced(text: Column, spans: Column) -> Column:
    """``text`` with every span (sorted, apart from each other) replaced by its kind in angle brackets."""

    def piece(cuts: Column, a: Column, b: Column) -> Column:
        first, last = F.floor(a / CUT).cast("int"), F.floor((b - 1) / CUT).cast("int")
        return F.when(a >= b, F.lit("")).otherwise(
            F.array_join(F.slice(cuts, first + 1, last - first + 1), "").substr((a % CUT) + 1, b - a))

    def build(cuts: Column) -> Column:
        gaps = F.transform(spans, lambda s, i: F.concat(
            piece(cuts, F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["end"]), s["start"]),
            F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        return F.concat(F.array_join(gaps, ""), piece(cuts, F.element_at(spans, -1)["end"], F.length(text)))

    whole = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    return F.when(F.size(spans) == 0, text).otherwise(let(whole, build))
