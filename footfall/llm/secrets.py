"""Secret scans: three fixed patterns, and random-looking strings by character Markov models."""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.exchange import hidden, others, shown

#: The three base kinds in their listed order; a failing match of ``assign`` still uses up its
#: text, while shorter runs of the other two kinds can hold no match, so their bound is in the
#: pattern.
ASSIGN = ("(([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+))")
ACCESS = "(AKIA[A-Z0-9]{16,})"
HEX = "([0-9a-f]{24,})"
ASSIGN_VALUE = 6
KINDS = ("assign", "access", "hex", "random")

#: What the Markov models look at.
RUN = "([A-Za-z0-9+/_=-]{16,})"
SYMBOLS = 68
#: Add-one-half smoothing, and the log-likelihood ratio per character from which a run counts
#: as random.
SMOOTHING = 0.5
THRESHOLD = 0.5

SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"
RUNS = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"
#: Entries of an array, and characters of a text, that are walked one by one; longer ones in two levels.
STRIDE, PIECE = 64, 1 << 16
FAR = 1 << 62


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """At each entry, ``merge`` (associative) of ``zero`` and all entries before it.

    Some entries at a time are folded anew for each of them, and their totals once more, so the work
    grows hardly faster than the array; appending to an array in a fold copies it each time.
    """
    def before(entries: Column) -> Column:
        return F.transform(entries, lambda _, j: F.aggregate(F.slice(entries, 1, j), zero, merge))

    def joined(strides: Column) -> Column:
        totals = F.transform(strides, lambda stride: F.aggregate(stride, zero, merge))
        return F.flatten(F.zip_with(strides, _let(totals, before), lambda stride, earlier: F.transform(
            before(stride), lambda own: merge(earlier, own))))

    strides = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / STRIDE).cast("int")),
                          lambda i: F.slice(values, i * STRIDE + 1, STRIDE))
    return F.when(F.size(values) > STRIDE, _let(strides, joined)).otherwise(before(values))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _matches(text: Column, pattern: str, kind: int, value_group: int = 1, least: int = 0) -> Column:
    """All matches with what their value group holds, leftmost first; those whose value is too short are
    left out.

    ``split`` gives what lies between the matches, so running lengths give positions.
    """
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    parts = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1)),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)),
        lambda whole, value: F.struct(F.length(whole).cast("long").alias("size"), value.alias("value")),
    )
    steps = _let(parts, lambda parts: F.zip_with(F.slice(between, 1, F.size(parts)), parts, lambda gap, part: F.struct(
        gap.alias("gap"), part["size"].alias("size"), part["value"].alias("value"))))

    def placed(steps: Column) -> Column:
        sizes = F.transform(steps, lambda step: step["gap"] + step["size"])
        starts = _let(sizes, lambda sizes: _running(sizes, F.lit(0).cast("long"), _plus))
        return F.filter(F.zip_with(starts, steps, lambda at, step: F.struct(
            (at + step["gap"]).alias("start"), F.lit(kind).alias("kind"),
            (at + step["gap"] + step["size"]).alias("end"), step["value"].alias("value"),
        )), lambda span: F.length(span["value"]) >= least)

    return F.when(text.rlike(pattern), _let(steps, placed)).otherwise(F.array().cast(RUNS))


def _without_values(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))


def base_spans(text: Column) -> Column:
    """Spans of the three fixed patterns by start, then kind; positions are code points."""
    return F.array_sort(_without_values(F.concat(
        _matches(text, ASSIGN, 0, value_group=3, least=ASSIGN_VALUE),
        _matches(text, ACCESS, 1),
        _matches(text, HEX, 2),
    )))


def free_runs(text: Column, base: Column) -> Column:
    """Runs that touch no base span, with their text as ``value``.

    Both in one order: the farthest end of the base spans before a run and the next start after it
    decide.
    """
    runs = _matches(text, RUN, 3)

    def untouched(events: Column) -> Column:
        ends = F.transform(events, lambda e: F.when(e["kind"] == 3, F.lit(-1).cast("long")).otherwise(e["end"]))
        starts = F.transform(F.reverse(events), lambda e: F.when(
            e["kind"] == 3, F.lit(FAR).cast("long")).otherwise(e["start"]))
        farthest = _let(ends, lambda x: _running(x, F.lit(-1).cast("long"), _larger))
        following = F.reverse(_let(starts, lambda x: _running(x, F.lit(FAR).cast("long"), _smaller)))
        judged = F.zip_with(F.arrays_zip(events.alias("e"), farthest.alias("f")), following, lambda x, n: F.struct(
            x["e"].alias("run"), ((x["e"]["kind"] == 3) & (x["f"] <= x["e"]["start"])
                                  & (n >= x["e"]["end"])).alias("free")))
        return F.transform(F.filter(judged, lambda x: x["free"]), lambda x: x["run"])

    valued = F.transform(base, lambda s: F.struct(
        s["start"], s["kind"], s["end"], F.lit("").alias("value")))
    return F.when(F.size(base) == 0, runs).otherwise(
        _let(F.array_sort(F.concat(valued, runs)), untouched))


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """Strings labelled by the fixed patterns: ``value`` and ``is_random``.

    What an access key, a hex run or an assignment holds is a random string; a run that touches
    none of them is an ordinary identifier.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(source.alias("t"), base_spans(source).alias("base"))
    values = F.concat(
        F.regexp_extract_all("t", F.lit(ACCESS), F.lit(1)),
        F.regexp_extract_all("t", F.lit(HEX), F.lit(1)),
        F.filter(F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(3)),
                 lambda v: F.length(v) >= ASSIGN_VALUE),
    )
    return found.select(F.explode(F.concat(
        F.when(F.size("base") > 0, F.transform(values, lambda v: F.struct(
            v.alias("value"), F.lit(True).alias("is_random"))))
        .otherwise(F.array().cast("array<struct<value:string,is_random:boolean>>")),
        F.transform(free_runs(F.col("t"), F.col("base")), lambda run: F.struct(
            run["value"].alias("value"), F.lit(False).alias("is_random"))),
    )).alias("sample")).select("sample.*")


def transition_counts(samples: DataFrame) -> DataFrame:
    """How often each character follows another, for random and ordinary strings.

    Rows (is_random, a, b, n) with ASCII codes; at most two for each pair of characters that a
    run can hold.
    """
    chars = F.filter(F.split("value", ""), lambda c: c.rlike("^[A-Za-z0-9+/_=.-]$"))
    pairs = F.zip_with(
        F.slice(F.col("chars"), 1, F.greatest(F.size("chars") - 1, F.lit(0))),
        F.slice(F.col("chars"), 2, F.greatest(F.size("chars") - 1, F.lit(0))),
        lambda a, b: F.ascii(a) * 128 + F.ascii(b),
    )
    return (
        samples.where(F.col("value").isNotNull() & F.col("is_random").isNotNull())
        .select("is_random", chars.alias("chars"))
        .select("is_random", F.explode(pairs).alias("pair"))
        .groupBy("is_random", "pair").agg(F.count(F.lit(1)).alias("n"))
        .select("is_random", F.floor(F.col("pair") / 128).cast("int").alias("a"),
                (F.col("pair") % 128).cast("int").alias("b"), "n")
    )


def likelihood_ratios(counts: DataFrame) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) at place 128 * a + b, smoothed.

    The counts are collected: both models have one number per pair of characters, whatever the
    corpus holds.
    """
    pair: dict[tuple[bool, int, int], int] = {}
    first: dict[tuple[bool, int], int] = {}
    for row in counts.collect():
        pair[row.is_random, row.a, row.b] = row.n
        first[row.is_random, row.a] = first.get((row.is_random, row.a), 0) + row.n

    def log_p(model: bool, a: int, b: int) -> float:
        return math.log((pair.get((model, a, b), 0) + SMOOTHING)
                        / (first.get((model, a), 0) + SMOOTHING * SYMBOLS))

    return [log_p(True, a, b) - log_p(False, a, b) for a in range(128) for b in range(128)]


def _ratio(value: Column, table: Column) -> Column:
    """The mean log-likelihood ratio of the characters of a run."""
    chars = F.split(value, "")
    n = F.length(value) - 1
    steps = F.zip_with(F.slice(chars, 1, n), F.slice(chars, 2, n), lambda a, b: F.element_at(
        table, F.ascii(a) * 128 + F.ascii(b) + 1))
    return F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + x) / n


def scan_secrets(docs: DataFrame, samples: DataFrame, text: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """Add a column ``spans`` to ``docs``: (start, kind, end) by start, then kind.

    ``kind`` counts from 0 through :data:`KINDS`; ``start`` and ``end`` are code points, the end
    exclusive.  Kinds 0 to 2 are the fixed patterns.  Kind 3 are other runs of 16 characters or
    more whose mean log-likelihood ratio between a Markov model of random strings and one of
    ordinary identifiers, both trained from ``samples`` (``value``, ``is_random``), is at least
    ``threshold``.

    Two passes over the texts, the first of which trains; nothing but transition counts is
    shuffled, and rows stay where they are, so no key can be hot.  A NULL text is empty and has
    no spans.  Without samples of either label no ratio is positive and only base spans remain.
    """
    ratios = likelihood_ratios(transition_counts(samples))
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    source = F.coalesce(F.col(text), F.lit(""))
    kept = others(docs.columns, ["spans"])
    found = docs.select(*hidden(kept), source.alias("_text"), base_spans(source).alias("_base"))
    random = _without_values(F.filter(
        free_runs(F.col("_text"), F.col("_base")), lambda run: _ratio(run["value"], table) >= threshold))
    return found.select(*shown(kept), F.array_sort(F.concat(F.col("_base"), random)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
        s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each span, or overlapping spans together, replaced by ``mark``."""
    zero = F.lit(0).cast("long")
    n_pieces = F.greatest(F.ceil(F.length(text) / PIECE), F.lit(1)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), n_pieces - 1),
                         lambda i: text.substr(i * PIECE + 1, F.lit(PIECE)))

    def part(pieces: Column, start: Column, end: Column) -> Column:
        """Characters of the text from its pieces, so that none is sought from the text's beginning."""
        first, last = (F.floor(at / PIECE).cast("int") for at in (start, end - 1))
        return F.when(end > start, F.array_join(F.transform(F.sequence(first, last), lambda i: F.get(pieces, i).substr(
            (F.greatest(start - i * PIECE, zero) + 1).cast("int"),
            (F.least(end - i * PIECE, F.lit(PIECE)) - F.greatest(start - i * PIECE, zero)).cast("int"))), "")).otherwise("")

    def walked(pieces: Column) -> Column:
        ends = F.transform(spans, lambda s: s["end"])
        done = _let(ends, lambda x: _running(x, zero, _larger))
        groups = F.filter(F.zip_with(spans, done, lambda s, at: F.struct(s["start"].alias("start"), at.alias("at"))),
                          lambda g: g["start"] >= g["at"])
        shown_parts = F.transform(groups, lambda g: F.concat(part(pieces, g["at"], g["start"]), F.lit(mark)))
        return F.concat(F.array_join(shown_parts, ""),
                        part(pieces, F.array_max(ends), F.length(text).cast("long")))

    return F.when(F.size(spans) > 0, _let(pieces, walked)).otherwise(text)
